"""Text cleaning as native column expressions.

Every function takes a column or its name and returns a ``Column``; nothing here
starts a Python worker, null stays null, and the same expression serves batch
and stream.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English stop words, plus the HTML entity remnant "amp".
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your
    yours yourself yourselves he him his himself she she's her hers herself it
    it's its itself they them their theirs themselves what which who whom this
    that that'll these those am is are was were be been being have has had
    having do does did doing a an the and but if or because as until while of
    at by for with about against between into through during before after above
    below to from up down in out on off over under again further then once here
    there when where why how all any both each few more most other some such no
    nor not only own same so than too very s t can will just don don't should
    should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't
    doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn
    mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn
    wasn't weren weren't won won't wouldn wouldn't
    amp
    """.split()
)

# Patterns whose matches decide the cleaned text.  The predefined
# classes \w, \d and \p{Alnum} are ASCII-only in Java; \P{Alnum} is several times
# faster there than the equal [^a-zA-Z0-9], a union of ranges.
# (?U) gives \s its Unicode meaning; U+001C..U+001F count as blanks too.
URL = r"(?U)http[^\s\x1c-\x1f]+"
# A match can only begin where a run of local-part characters begins, or where
# the previous match ended.  Saying so keeps long unbroken runs linear.
EMAIL = r"(?:\G|(?<![a-z0-9.\-+_]))[a-z0-9.\-+_]++@[a-z0-9.\-+_]+\.[a-z]+"
# Found exactly where EMAIL has a match, but looks at nothing up to the first @.
HAS_EMAIL = r"@(?<=[a-z0-9.\-+_]@)[a-z0-9.\-+_]+\.[a-z]"
NOT_ALNUM = r"\P{Alnum}+"
NOT_LOWER = r"[^a-z]+"
DIGITS = r"\d+"
MENTION = r"@\w+"
HASHTAG = r"#\w+"
HASHTAG_BODY = r"#(\w{1,50})"
NUMBER_MARK = "[num]"


def _as_column(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def is_kept(word: Column) -> Column:
    """True for a token that is neither empty nor a stop word (a hash-set test)."""
    return ~word.isin("", *STOP_WORDS)


def _keep(words: Column) -> Column:
    return F.filter(words, is_kept)


def _without(text: Column | str, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def normalise(text: Column | str) -> Column:
    """Drop URLs and e-mail addresses, keep letters and digits, mark numbers, lower-case."""
    text = _as_column(text)
    plain = _without(text, URL)
    # Removing URLs only shortens runs of non-blanks and so never forms a new
    # address; the cheap test may look at the given text.
    plain = F.when(text.rlike(HAS_EMAIL), _without(plain, EMAIL)).otherwise(plain)
    plain = F.lower(F.regexp_replace(plain, NOT_ALNUM, " "))
    return F.regexp_replace(plain, DIGITS, NUMBER_MARK)


def split_words(text: Column | str) -> Column:
    """Normalised text as tokens, stop words and empty edge tokens still inside."""
    return F.split(normalise(text), " ")


def tokens(text: Column | str) -> Column:
    """Model tokens in order, repeats kept."""
    return _keep(split_words(text))


def clean(text: Column | str) -> Column:
    """Text as the classifier sees it.  Not idempotent: ``[num]`` becomes ``num``."""
    return F.array_join(tokens(text), " ")


def without_hashtags(text: Column | str) -> Column:
    return _without(text, HASHTAG)


def clean_no_hashtag(text: Column | str) -> Column:
    """``clean`` after removing whole hashtags."""
    return clean(without_hashtags(text))


def eda_split_words(text: Column | str, lower_first: bool = False) -> Column:
    """Exploration tokens before stop-word removal.

    Capital letters count as separators (``Hello`` gives ``ello``) unless
    ``lower_first`` is set.
    """
    text = _without(_without(text, MENTION), HASHTAG)
    if lower_first:
        text = F.lower(text)
    return F.split(F.regexp_replace(text, NOT_LOWER, " "), " ")


def eda_tokens(text: Column | str, lower_first: bool = False) -> Column:
    return _keep(eda_split_words(text, lower_first))


def clean_eda(text: Column | str, lower_first: bool = False) -> Column:
    """Text as the exploratory reports see it."""
    return F.array_join(eda_tokens(text, lower_first), " ")


def hashtags(text: Column | str) -> Column:
    """Hashtag bodies in order; a body longer than 50 characters is cut at 50."""
    return F.regexp_extract_all(text, F.lit(HASHTAG_BODY), F.lit(1))


def hashtag_text(text: Column | str) -> Column:
    return F.array_join(hashtags(text), " ")


def split_count(text: Column | str) -> Column:
    """Number of pieces after splitting at each blank: 1, not 0, for empty text."""
    text = _as_column(text)
    return F.when(text.isNotNull(), F.size(F.split(text, " ")))


def word_count(text: Column | str) -> Column:
    """Number of non-empty words; 0 for empty text, null for null."""
    text = _as_column(text)
    return F.when(text == "", 0).otherwise(split_count(text))


def mentions_phrase(text: Column | str, phrase: str) -> Column:
    return _as_column(text).contains(phrase)
