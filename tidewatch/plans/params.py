"""Parameter tables.

Two kinds live here:

1. FIXED VALUES of the scoring model (keyword tables, default profiles,
   scenario weights).  They must keep exactly these values for results to
   agree with the published artifacts; they are listed plainly, in their
   natural order.
2. Fixture parameters used by the registered queries on the driver tables
   (sentiment lexicon, topic configuration).  These are inputs a user supplies.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (model constants)
# ---------------------------------------------------------------------------

# English stop words of the term extraction (the default list of Spark ML's remover).
STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
her hers herself it its itself they them their theirs themselves what which who whom this that
these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll
i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
""".split())

# Genre keyword table; table order is the tie-break order.
GENRE_KEYWORDS = (
    ("ambient", ("meditation", "sleep", "calm", "mindfulness", "healing", "zen")),
    ("electronic", ("ai", "digital", "synth", "cyber", "future", "beat")),
    ("pop", ("love", "dance", "dream", "summer", "heart", "radio")),
    ("indie", ("lofi", "bedroom", "indie", "acoustic", "soft")),
    ("classical", ("piano", "orchestra", "instrumental", "string", "sonata")),
    ("hiphop", ("rap", "trap", "flow", "bars", "beat")),
)

# Genre used when a record has neither audio features nor keyword hits.
TOPIC_DEFAULT_GENRE = (
    ("AI music", "electronic"),
    ("Digital art", "electronic"),
    ("Mindfulness", "ambient"),
    ("Sustainable fashion", "indie"),
)
FALLBACK_GENRE = "electronic"

# Visual default profile per known topic: brightness, colorfulness, edge density.
TOPIC_VISUAL_DEFAULTS = (
    ("AI music", 0.58, 0.62, 0.60),
    ("Sustainable fashion", 0.66, 0.48, 0.42),
    ("Mindfulness", 0.72, 0.34, 0.24),
    ("Digital art", 0.63, 0.82, 0.74),
)

# Audio default profile per known topic: energy score, novelty signal.
TOPIC_AUDIO_DEFAULTS = (
    ("AI music", 0.76, 0.69),
    ("Sustainable fashion", 0.46, 0.42),
    ("Mindfulness", 0.24, 0.30),
    ("Digital art", 0.61, 0.72),
)

# Genome axes and their keywords, in axis order.
GENOME_AXES = (
    ("innovation", ("ai", "digital", "future", "generated", "creative", "technology", "coding")),
    ("tradition", ("repair", "craft", "ethical", "mindfulness", "meditation", "human", "slow")),
    ("wellness", ("wellness", "mindfulness", "meditation", "focus", "stress", "calm", "health")),
    ("community", ("community", "social", "collective", "culture", "shared", "consumer", "artists")),
    ("expression", ("art", "music", "design", "visual", "creative", "fashion", "artist")),
)

# Scenario weights on (innovation, tradition, wellness, community, expression).
SCENARIOS = (
    ("AI Regulation Crackdown", (-0.45, 0.10, 0.05, 0.00, -0.08)),
    ("Climate Activism Surge", (0.05, 0.18, 0.05, 0.22, 0.05)),
    ("Creator Economy Boom", (0.22, -0.05, 0.00, 0.08, 0.25)),
    ("Mental Health Priority Shift", (0.00, 0.08, 0.30, 0.10, 0.02)),
    ("Recession Shock", (-0.10, 0.14, 0.06, 0.10, -0.12)),
)

# Built-in topic configuration used when no topic file exists:
# name, news query, track query, post terms, communities.
DEFAULT_TOPICS = (
    ("AI music", "AI music", "AI music",
     ("AI music", "generative music", "music AI"),
     ("technology", "music", "artificial", "MachineLearning")),
    ("Sustainable fashion", "sustainable fashion", "sustainable fashion",
     ("sustainable fashion", "ethical fashion", "slow fashion"),
     ("fashion", "femalefashionadvice", "malefashionadvice", "worldnews")),
    ("Mindfulness", "mindfulness", "meditation",
     ("mindfulness", "meditation", "mental wellness"),
     ("Meditation", "mindfulness", "DecidingToBeBetter", "worldnews")),
    ("Digital art", "digital art", "digital art",
     ("digital art", "creative coding", "AI art"),
     ("digitalart", "art", "technology", "datascience")),
)

# ---------------------------------------------------------------------------
# Fixture parameters for the driver tables
# ---------------------------------------------------------------------------

# Sentiment lexicon (word, polarity): words that occur in the fixture corpus.
LEXICON = (
    ("best", 1.0),
    ("worthless", -0.8),
    ("thing", 0.1),
    ("nicht", -0.3),
    ("mente", 0.2),
    ("thble", -0.1),
)
NEGATORS = ("not", "no", "never")

# Topic configuration over the fixture topics (event types) for the matcher.
FIXTURE_TOPICS = (
    ("view", "the", "view", ("the", "watch"), ("*",)),
    ("click", "and", "click", ("and",), ("*",)),
    ("purchase", "with", "purchase", ("with", "buy", "order"), ("*",)),
    ("signup", "des", "signup", ("des", "join"), ("*",)),
    ("error", "der", "error", ("der", "fail"), ("*",)),
)

# Keyword tables that fire on the fixture corpus (same shape as the fixed ones).
FIXTURE_GENRE_KEYWORDS = (
    ("ambient", ("zen", "calm", "eau")),
    ("electronic", ("ai", "tion", "beat")),
    ("pop", ("love", "que", "the")),
    ("indie", ("soft", "ment")),
    ("classical", ("piano", "lich")),
    ("hiphop", ("rap", "ing", "beat")),
)

FIXTURE_GENOME_AXES = (
    ("innovation", ("ai", "tion", "future")),
    ("tradition", ("der", "craft", "und")),
    ("wellness", ("calm", "ment", "eau")),
    ("community", ("the", "and", "social")),
    ("expression", ("art", "que", "ble")),
)
