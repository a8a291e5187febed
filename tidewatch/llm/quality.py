"""Quality rules, line first (operator 7).

Method: punctuation, navigation and boilerplate rules are evaluated per line,
failing lines go, and documents that lose too much text are rejected.

Line rules (a line without a word is not judged and counts as nothing):

* symbols: a tenth of the word characters or more are ``[#*$%&|<>]``;
* navigation: two or more separators (``| > » ·``), one per three words or more;
* shouting: five words or more, all in upper case;
* exclamation: five words or more and a ``!`` for every second word;
* punctuation: thirty words or more without a stop of any script (``STOPS``);
* boilerplate: a phrase of ``BOILERPLATE`` as whole words.

A document fails the base rules with fewer than 50 words, or with more than
half of its words in three-word windows that come twice or more.  It is kept
if it passes them and its removed lines hold at most ``LOSS_PERCENT`` of its
word characters.

Everything is one pass over the text inside tasks (no shuffle, no group across
documents).  Words are ``[^\\x20\\x09-\\x0D]+``.  Null text counts as empty (no words, base
rules failed); null ids and repeated rows keep their rows; empty table, empty
result; extra columns are ignored by ``quality_report`` and kept by
``clean_documents``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import kernels as K

LEAST_WORDS = 50
REPEAT_PERCENT = 50
LOSS_PERCENT = 40
STOPS = ".!?;:…。！？；：．｡،؛؟۔।॥።፧။។՞։"
BOILERPLATE = (r"cookies?|privacy policy|all rights reserved|terms of (?:use|service)|enable javascript|"
               r"subscribe|sign up|log in|copyright|licensed under")

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
_SEPARATOR = re.compile(r"[|>»·]")
_STOP = re.compile(f"[{STOPS}]")
_BOILERPLATE = re.compile(rf"(?<!\w)(?:{BOILERPLATE})(?!\w)", re.IGNORECASE)
_SYMBOL_BYTES = np.zeros(256, dtype=bool)
_SYMBOL_BYTES[list(b"#*$%&|<>")] = True
# bytes that begin a character and are no white space
_SOLID = np.array([(c & 0xC0) != 0x80 for c in range(256)]) & ~K.SPACE


def line_fails(line: str, words: list[str]) -> bool:
    n, chars = len(words), sum(map(len, words))
    symbols = len(_SYMBOL.findall(line))
    if 10 * symbols >= chars:
        return True
    separators = len(_SEPARATOR.findall(line))
    if separators >= 2 and 3 * separators >= n:
        return True
    if n >= 5 and (2 * line.count("!") >= n or (line == line.upper() and line != line.lower())):
        return True
    if n >= 30 and not _STOP.search(line):
        return True
    return bool(_BOILERPLATE.search(line))


def judge_lines(text: str) -> tuple[int, int, int, str]:
    """(repeated lines, removed lines, removed word characters, remaining text)."""
    seen, repeated, removed, lost, left = set(), 0, 0, 0, []
    for line in text.split("\n"):
        words = _WORD.findall(line)
        if words:
            if line in seen:
                repeated += 1
            seen.add(line)
            if line_fails(line, words):
                removed += 1
                lost += sum(map(len, words))
                continue
        left.append(line)
    return repeated, removed, lost, "\n".join(left)


def repeat_words(words: np.ndarray) -> int:
    """Words in three-word windows that come twice or more."""
    if len(words) < 4:
        return 0
    _, which, count = np.unique(K.shingles_of(words, 3), return_inverse=True, return_counts=True)
    again = count[which] > 1
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k:k + len(again)] |= again
    return int(covered.sum())


_COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_lines",
            "lost_chars", "clean")


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, off = K.text_buffers(batch.column(1))
        texts = batch.column(1).to_pylist()
        numbers: list[list[int]] = [[] for _ in range(7)]
        clean = []
        for i, j in K.slices(off):
            buf, rel = raw[off[i]:off[j]], off[i:j + 1] - off[i]
            words, first = K.words_of(raw, off, i, j, lower=False)
            solid, symbols = (np.concatenate([[0], np.cumsum(table[buf])]) for table in (_SOLID, _SYMBOL_BYTES))
            for k in range(j - i):
                repeated, removed, lost, left = judge_lines(texts[i + k] or "")
                own = words[first[k]:first[k + 1]]
                for out, value in zip(numbers, (len(own), solid[rel[k + 1]] - solid[rel[k]],
                                                symbols[rel[k + 1]] - symbols[rel[k]], repeated, repeat_words(own),
                                                removed, lost)):
                    out.append(int(value))
                clean.append(left if removed else texts[i + k])
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, pa.int64()) for v in numbers],
                                          pa.array(clean, pa.string())], list(_COLUMNS))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures and verdict per row; ``clean`` is the text without failed lines."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = ", ".join(f"{c} {'string' if c == 'clean' else 'bigint'}" for c in _COLUMNS)
    n, repeat = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < LEAST_WORDS) | (100 * repeat > REPEAT_PERCENT * n)
    kept = ~failed & (100 * F.col("lost_chars") <= LOSS_PERCENT * F.col("word_chars"))
    return rows.mapInArrow(_measure, schema).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        kept.alias("kept"), "n_removed_lines", "lost_chars", "clean")


QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM d),
l AS (SELECT doc_id, line, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
        len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
      FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
j AS (SELECT *, 10 * length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) >= chars
        OR (length(regexp_replace(line, '[^|>»·]', '', 'g')) >= 2 AND 3 * length(regexp_replace(line, '[^|>»·]', '', 'g')) >= n)
        OR (n >= 5 AND (2 * length(regexp_replace(line, '[^!]', '', 'g')) >= n OR (line = upper(line) AND line <> lower(line))))
        OR (n >= 30 AND NOT regexp_matches(line, '[@STOPS@]'))
        OR regexp_matches(line, '(?i)(?:^|[^\p{L}\p{N}_])(?:@BOILERPLATE@)(?:[^\p{L}\p{N}_]|$)') AS bad
      FROM l WHERE n > 0),
x AS (SELECT doc_id, coalesce(sum(chars) FILTER (bad), 0)::BIGINT AS lost_chars, (count(*) FILTER (bad))::BIGINT AS n_removed_lines,
        (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines FROM j GROUP BY doc_id),
p AS (SELECT doc_id, unnest(w) AS a, unnest(range(len(w))) AS i FROM m),
q AS (SELECT doc_id, i, a, lead(a) OVER s AS b, lead(a, 2) OVER s AS c FROM p WINDOW s AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, c IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, a, b, c) > 1 AS again FROM q),
v AS (SELECT doc_id, again OR coalesce(lag(again) OVER s, false) OR coalesce(lag(again, 2) OVER s, false) AS covered
      FROM r WINDOW s AS (PARTITION BY doc_id ORDER BY i)),
y AS (SELECT doc_id, (count(*) FILTER (covered))::BIGINT AS n_repeat_words FROM v GROUP BY doc_id),
z AS (SELECT m.doc_id, len(w)::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        coalesce(n_removed_lines, 0) AS n_removed_lines, coalesce(lost_chars, 0) AS lost_chars
      FROM m LEFT JOIN x USING (doc_id) LEFT JOIN y USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost_chars <= 40 * word_chars AS kept,
  n_removed_lines, lost_chars
FROM z
""".replace("@BOILERPLATE@", BOILERPLATE).replace("@STOPS@", STOPS)


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with cleaned texts, without the rejected ones (same columns)."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbered = pa.RecordBatch.from_arrays(
                [pa.array(range(batch.num_rows), pa.int64()), batch.column(at)], ["doc_id", "text"])
            m = next(_measure(iter([numbered])))
            get = {c: np.array(m.column(k).to_pylist()) for k, c in enumerate(_COLUMNS[:-1])}
            keep = ((get["n_words"] >= LEAST_WORDS) & (100 * get["n_repeat_words"] <= REPEAT_PERCENT * get["n_words"])
                    & (100 * get["lost_chars"] <= LOSS_PERCENT * get["word_chars"]))
            columns = [*batch.columns]
            columns[at] = m.column(len(_COLUMNS) - 1)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, schema)
