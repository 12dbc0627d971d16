"""Token-level text expressions.

Tokenisation follows the reference semantics exactly: lower-case, split on a
single space (so two spaces give an empty token), and for lexicon building
remove every character that is not an ASCII letter.
"""

from __future__ import annotations

from string import ascii_letters

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The public NLTK English stopword list (179 words, in its
# natural order), followed by the four extra tokens the reference adds.
# They are compared against cleaned, lower-cased tokens.
# ---------------------------------------------------------------------------
NLTK_ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his
himself she she's her hers herself it it's its itself they them their theirs themselves what which who whom this
that that'll these those am is are was were be been being have has had having do does did doing a an the and but
if or because as until while of at by for with about against between into through during before after above below
to from up down in out on off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will just don don't should
should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't
haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't
weren weren't won won't wouldn wouldn't
""".split()
EXTRA_STOPWORDS = ["xxxx", "xxxxxxxx", "xxxxxxxxxxxx", ""]
STOPWORDS = NLTK_ENGLISH_STOPWORDS + EXTRA_STOPWORDS

# The letters are listed: Java looks single characters up in a bitmap, while a class of two ranges
# (a-zA-Z) takes some eight times as long over a text.
NON_LETTERS = f"[^{ascii_letters}]+"
NON_LETTERS_OR_SPACE = f"[^{ascii_letters} ]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(text) -> Column:
    """``lower(text)`` split on single spaces, empty tokens kept."""
    return F.split(F.lower(_col(text)), " ", -1)


def cleaned_tokens(text) -> Column:
    """The cleaned form of every token of :func:`tokens`, position by position.

    Removing non-letters token by token equals removing every character that
    is neither a letter nor a space from the whole text and then splitting on
    the space: the removal never touches a separator. One regex pass per
    document instead of one per token.
    """
    return F.split(F.regexp_replace(F.lower(_col(text)), NON_LETTERS_OR_SPACE, ""), " ", -1)


def clean_token(tok) -> Column:
    """Drop every character that is not an ASCII letter."""
    return F.regexp_replace(_col(tok), NON_LETTERS, "")


def is_stopword(tok, stopwords=None, lowercase: bool = True) -> Column:
    """Membership in a fixed, bounded word list: an ``InSet`` filter that
    stays inside whole-stage codegen (no join needed). Pass
    ``lowercase=False`` when the tokens are already lower-case."""
    words = STOPWORDS if stopwords is None else list(stopwords)
    tok = _col(tok)
    return (F.lower(tok) if lowercase else tok).isin(words)


def has_non_blank(c) -> Column:
    """True when the text has at least one non-whitespace character."""
    return _col(c).rlike(r"\S")
