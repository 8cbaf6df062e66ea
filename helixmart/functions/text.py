"""Text clean-up: trimming, typographic punctuation, Greek letters, plain ASCII."""

from __future__ import annotations

import sys

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The Arrow helpers travel to the executors by value: workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- fixed values -----------------------------------------------------------------------
# White space as Unicode text defines it (Java's \s and trim() know ASCII blanks only).
WHITESPACE = (
    "\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Typographic marks and their ASCII stand-ins.
PUNCTUATION = {
    "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2014": "-", "\u2212": "-",
    "“": '"', "”": '"', "„": '"', "‟": '"', "«": '"', "»": '"',
    "‘": "'", "’": "'", "‚": "'", "‹": "'", "›": "'",
    "×": "x", "·": ".", "±": "+/-", "µ": "u", "°": "deg", "\u00a0": " ",
}

# Greek letters and their names. Capital omicron is spelled "sigma": stored data carries it so.
GREEK = {
    "α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "ε": "epsilon", "ζ": "zeta",
    "η": "eta", "θ": "theta", "ι": "iota", "κ": "kappa", "λ": "lambda", "μ": "mu",
    "ν": "nu", "ξ": "xi", "ο": "omicron", "π": "pi", "ρ": "rho", "σ": "sigma",
    "ς": "sigma", "τ": "tau", "υ": "upsilon", "φ": "phi", "χ": "chi", "ψ": "psi",
    "ω": "omega",
    "Α": "alpha", "Β": "beta", "Γ": "gamma", "Δ": "delta", "Ε": "epsilon", "Ζ": "zeta",
    "Η": "eta", "Θ": "theta", "Ι": "iota", "Κ": "kappa", "Λ": "lambda", "Μ": "mu",
    "Ν": "nu", "Ξ": "xi", "Ο": "sigma", "Π": "pi", "Ρ": "rho", "Σ": "sigma",
    "Τ": "tau", "Υ": "upsilon", "Φ": "phi", "Χ": "chi", "Ψ": "psi", "Ω": "omega",
}
# ----------------------------------------------------------------------------------------

# The same white space as ranges, which the regex engine tests much faster than a list.
_WIDE_BLANKS = r"\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_BLANKS = rf"[\x09-\x0D\x1C-\x20{_WIDE_BLANKS}]"
_NOT_BLANK = rf"[^\x09-\x0D\x1C-\x20{_WIDE_BLANKS}]"
# Only runs that differ from one plain space; ordinary prose then has few matches.
_BLANK_RUN = rf"[\x09-\x0D\x1C-\x1F{_WIDE_BLANKS}]{_BLANKS}*| {_BLANKS}+"
_FOREIGN = r"[^\x00-\x7F]"


def strip(c: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _class_of(table: dict[str, str]) -> str:
    """The characters as ranges of a regular expression, which are tested faster than single ones."""
    points = sorted(map(ord, table))
    starts = [p for p in points if p - 1 not in points]
    ends = [p for p in points if p + 1 not in points]
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends, strict=True))


_SINGLE = {mark: text for mark, text in PUNCTUATION.items() if len(text) == 1}
_LONGER = {mark: text for mark, text in PUNCTUATION.items() if len(text) > 1}


def _spelled(c: Column, table: dict[str, str]) -> Column:
    """Each of ``table``'s characters replaced, in one pass over the text, however many there are."""
    marks = _class_of(table)
    names = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    tokens = F.regexp_extract_all(c, F.lit(f"[{marks}]|[^{marks}]+"), F.lit(0))
    return F.array_join(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(names, t), t)), "")


def _tidied(c: Column) -> Column:
    """Marks with a stand-in of one character."""
    return F.translate(c, "".join(_SINGLE), "".join(_SINGLE.values()))


def tidy_punct(c: Column) -> Column:
    """Typographic punctuation to ASCII; rows without any pass untouched."""
    single = F.when(c.rlike(f"[{_class_of(_SINGLE)}]"), _tidied(c)).otherwise(c)
    return F.when(c.rlike(f"[{_class_of(_LONGER)}]"), _spelled(_tidied(c), _LONGER)).otherwise(single)


def _squeezed(c: Column) -> Column:
    """Runs of white space to one space, trimmed, lower case; ``c`` stands in the expression once."""
    return F.lower(F.trim(F.regexp_replace(c, _BLANK_RUN, " ")))


def _squeeze(c: Column) -> Column:
    return F.when(c.rlike(_NOT_BLANK), _squeezed(c))


# Spark has no Unicode normalisation: rows with foreign characters go to one Arrow kernel.
@F.arrow_udf(StringType())
def _base_letters(texts: pa.Array) -> pa.Array:
    """Marks and Greek letters spelled, white space squeezed, then the compatibility decomposition's ASCII characters
    in lower case; NULL when nothing is left."""
    for mark, stand_in in [*PUNCTUATION.items(), *GREEK.items()]:
        texts = pc.replace_substring(texts, pattern=mark, replacement=stand_in)
    texts = pc.utf8_trim(pc.replace_substring_regex(texts, pattern=_BLANK_RUN, replacement=" "), characters=" ")
    foreign = pc.invert(pc.string_is_ascii(texts))
    if pc.any(foreign).as_py():
        letters = pc.utf8_normalize(texts.filter(foreign), form="NFKD")
        letters = pc.replace_substring_regex(letters, pattern=_FOREIGN, replacement="")
        texts = pc.replace_with_mask(texts, pc.fill_null(foreign, False), letters)
    texts = pc.utf8_trim(pc.ascii_lower(texts), characters=WHITESPACE)
    return pc.if_else(pc.equal(texts, ""), None, texts)


def ascii_slug(c: Column) -> Column:
    """Spell Greek letters, collapse white space, trim, lower-case; blank gives NULL."""
    return F.when(c.rlike(f"[{_class_of(GREEK)}]"), _squeezed(_spelled(c, GREEK))).otherwise(_squeeze(c))


def lowercase_ascii(c: Column) -> Column:
    """Lower-case ASCII text; NULL when nothing is left."""
    foreign = c.rlike(_FOREIGN)
    return F.when(foreign, _base_letters(F.when(foreign, c))).otherwise(_squeeze(c))
