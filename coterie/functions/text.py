"""Text expressions: tokens, shingles and clean-up."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters stripped from both ends of a title word.
STRIPPED_CHARACTERS = "\"'();,:./"

# Title words that say nothing about a topic.
TITLE_STOP_WORDS = [
    "a", "for", "and", "of", "the", "with", "in", "to", "-", "an", "on", "by", "abstract",
    "bibliography", "title", "data", "base", "bases", "paper", "sigmod", "acm", "sigfidet",
    "codasyl", "at", "using", "databases", "database", "efficient", "system", "systems",
    "contents", "content", "editor's", "conference", "management", "proceedings", "new",
]

# The English stop words of Spark ML.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
her hers herself it its itself they them their theirs themselves what which who whom this that
these those am is are was were be been being have has had having do does did doing a an the
and but if or because as until while of at by for with about against between into through
during before after above below to from up down in out on off over under again further then
once here there when where why how all any both each few more most other some such no nor not
only own same so than too very s t can will just don should now i'll you'll he'll she'll we'll
they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't
wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's
there's what's when's where's who's why's would
""".split()


def tokens(body: Column) -> Column:
    """The body split at single spaces."""
    return F.split(body, " ")


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, also where ``use`` loops over it."""
    return F.transform(F.array(value), use)[0]


def word_windows(body: Column, size: int) -> Column:
    """Array of all runs of ``size`` tokens joined by a space; empty for shorter bodies."""

    def runs(units: Column) -> Column:
        last = F.size(units) - (size - 1)
        starts = F.when(last >= 1, F.sequence(F.lit(1), last))
        joined = F.transform(starts, lambda i: F.array_join(F.slice(units, i, F.lit(size)), " "))
        return F.coalesce(joined, F.array().cast("array<string>"))

    return bound(tokens(body), runs)


def character_windows(body: Column, size: int) -> Column:
    """Array of all runs of ``size`` characters; empty for shorter bodies.

    One pass over the text: at every character a lookahead takes the run that starts there.
    """
    runs = F.regexp_extract_all(body, F.lit(rf"(?s)(?=(.{{{size}}}))."), 1)
    return F.coalesce(runs, F.array().cast("array<string>"))


def strip_markup(html: Column) -> Column:
    """Text of an HTML fragment: comments and tags removed, the five basic entities decoded."""
    text = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"<[^>]*>", " ")
    for entity, character in (
        ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"),
    ):
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def content_words(text: Column, stop_words: list[str], min_letters: int = 3) -> Column:
    """Lower-case runs of letters, without stop words and words under ``min_letters`` letters."""
    words = F.transform(F.regexp_extract_all(text, F.lit(r"(\p{L}+)"), 1), F.lower)
    return F.filter(words, lambda word: ~word.isin(stop_words) & (F.length(word) >= min_letters))


def title_words(title: Column) -> Column:
    """Words of a title that count: stripped, lower-case, no stop word, no digit, not empty."""
    words = F.transform(
        F.split(title, " "), lambda word: F.lower(F.btrim(word, F.lit(STRIPPED_CHARACTERS)))
    )
    return F.filter(
        words,
        lambda word: (F.length(word) > 0)
        & ~word.isin(TITLE_STOP_WORDS)
        & ~word.rlike("[0-9]"),
    )
