"""Sketches are written once, of listed documents only, when the retained values are gone."""

from tidewatch.llm import near_dup as ND
from tidewatch.llm.store import Scratch


def test_sketches_are_never_held_with_the_retained_values(spark, monkeypatch):
    base = " ".join(f"w{i}" for i in range(60))
    texts = [base, base + " end", "other " + " ".join(f"v{i}" for i in range(40)), "", None, base]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    held, seen = {}, []
    keep, drop = Scratch.keep, Scratch.drop

    def kept(self, df, name):
        held[name] = df.columns
        seen.append({n: set(c) for n, c in held.items()})
        out = keep(self, df, name)
        if name == "sketches":
            assert sorted(r["doc_id"] for r in out.collect()) == [0, 1]
        return out

    def dropped(self, *names):
        for n in names:
            held.pop(n, None)
        drop(self, *names)

    monkeypatch.setattr(Scratch, "keep", kept)
    monkeypatch.setattr(Scratch, "drop", dropped)
    got = {r["doc_id"]: r["component_id"] for r in ND.near_duplicates(docs, shingle=2).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 0}
    assert any("sketch" in c for tables in seen for c in tables.values())
    assert not any(any("sketch" in c for c in t.values()) and any("kept" in c for c in t.values()) for t in seen)
