"""Text expressions: cleaning, title case, accents, slugs, tokens and names."""

from __future__ import annotations

import hashlib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Latin letters that decompose into a letter and marks, and that letter.
_DECOMPOSED = {chr(c): unicodedata.normalize("NFD", chr(c)) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))}
ACCENTED = "".join(c for c, parts in _DECOMPOSED.items() if len(parts) > 1 and all(map(unicodedata.combining, parts[1:])))
PLAIN = "".join(_DECOMPOSED[c][0] for c in ACCENTED)
#: Particles that stay lower case inside a French name.
PARTICLES = ("de", "du", "des", "la", "le", "les", "et")
#: Generic words of club names.
STOPWORDS = (
    "handball", "club", "association", "asso", "sport", "sports", "sporting", "sportif", "sportive", "sportives",
    "omnisports", "omnisport", "asptt", "elan", "avenir", "jeune", "jeunes", "jeunesse", "etoile", "union", "amicale",
    "foyer", "groupe", "groupement", "entente", "olympique", "olympic",
)
#: Zero-width and direction marks and the byte order mark.
INVISIBLE = "[\\u200B-\\u200F\\uFEFF]"
#: Combining marks that decomposed input carries.
MARKS = "[\\u0300-\\u036F]"


def strip_accents(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, ACCENTED, PLAIN), MARKS, "")


def strip_upper(text: Column) -> Column:
    return F.upper(strip_accents(text))


#: White space as names carry it, beyond ASCII.
SPACES = "[\\s\\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]+"


@F.pandas_udf(StringType())
def _composed(text: pd.Series) -> pd.Series:
    return text.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def normalize(text: Column) -> Column:
    """Composed letters (NFC), then ``clean``; only texts with combining marks need Python."""
    return clean(F.when(text.rlike(MARKS), _composed(text)).otherwise(text))


def clean(text: Column) -> Column:
    """Without invisible characters, runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, INVISIBLE, ""), SPACES, " "))


def _capital(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, 2, 1 << 30)))


def title_case(text: Column) -> Column:
    """French title case: short elisions stay small, hyphens split, inner particles stay small."""

    def word(token: Column, i: Column) -> Column:
        apostrophe = F.instr(token, "'")
        elided = (apostrophe > 1) & (apostrophe < F.length(token)) & (apostrophe <= 3)
        rest = F.substring(token, apostrophe + 1, F.length(token))
        return (
            F.when(elided, F.concat(F.lower(F.substring(token, F.lit(1), apostrophe)), _capital(rest)))
            .when(F.contains(token, F.lit("-")), F.array_join(F.transform(F.split(token, "-"), _capital), "-"))
            .when((i > 0) & F.lower(token).isin(*PARTICLES), F.lower(token))
            .otherwise(_capital(token))
        )

    return F.array_join(F.transform(F.split(clean(text), " "), word), " ")


def slug(text: Column, length: int | None = None) -> Column:
    """Lower case, unaccented, other characters as one dash; one dash goes from each end."""
    dashed = F.regexp_replace(strip_accents(F.lower(text)), "[^a-z0-9]+", "-")
    out = F.regexp_replace(dashed, "^-|-$", "")
    return F.substring(out, 1, length) if length else out


def distinctive_tokens(name: Column) -> Column:
    """Distinct words of four letters or more that tell a club from others."""
    words = F.split(strip_accents(F.lower(name)), "[^a-z0-9]+")
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) >= 4) & ~w.isin(*STOPWORDS) & ~w.rlike("^[0-9]+$")))


def whole_word_pattern(tokens: Column) -> Column:
    """A regular expression for any of the words; null without words."""
    return F.when(F.size(tokens) > 0, F.concat(F.lit(r"(?i)\b("), F.array_join(tokens, "|"), F.lit(r")\b")))


def split_name(name: Column) -> Column:
    """(prenom, nom): the first word and the rest; null where there is no word."""
    words = F.split(clean(name), " ")
    rest = F.nullif(F.array_join(F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(1))), " "), F.lit(""))
    return F.when(clean(name) != "", F.struct(F.element_at(words, 1).alias("prenom"), F.when(F.size(words) > 1, rest).alias("nom")))


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """A capture group, null where the pattern doesn't match."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def template_route(path: Column) -> Column:
    """A path with its numeric segments replaced by ``:id``."""
    return F.regexp_replace(path, "/[0-9]+", "/:id")


def sheet_url(code: Column, base: str = "https://media.example.org/fdm") -> Column:
    """Match sheets lie under the first four characters of their code."""
    letters = [F.substring(code, i, 1) for i in range(1, 5)]
    return F.when(F.length(code) >= 4, F.concat(F.lit(base), F.lit("/"), F.concat_ws("/", *letters), F.lit("/"), code, F.lit(".pdf")))


def department(zipcode: Column) -> Column:
    """Department of a French postcode: three digits overseas, 2A or 2B in Corsica."""
    # 97 and 98 are overseas, 20 is Corsica, whose south ends below 20200.
    number = zipcode.try_cast("int")
    return (
        F.when(zipcode.isNull() | (F.length(zipcode) < 2), F.lit(None).cast("string"))
        .when(zipcode.rlike("^9[78]"), F.substring(zipcode, 1, 3))
        .when(zipcode.startswith("20"), F.when(number < 20200, F.lit("2A")).otherwise("2B"))
        .otherwise(F.substring(zipcode, 1, 2))
    )


def hmac_sha256(key: str, message: Column) -> Column:
    """HMAC-SHA256 in hexadecimal digits, from two hashes."""
    raw = key.encode()
    raw = (hashlib.sha256(raw).digest() if len(raw) > 64 else raw).ljust(64, b"\0")
    inner, outer = bytes(b ^ 0x36 for b in raw), bytes(b ^ 0x5C for b in raw)
    first = F.unhex(F.sha2(F.concat(F.lit(inner), message.cast("binary")), 256))
    return F.sha2(F.concat(F.lit(outer), first), 256)


def grouped_digits(number: Column) -> Column:
    """A whole number with a space between its thousands; ``-`` for null."""
    return F.coalesce(F.regexp_replace(number.cast("string"), r"\B(?=(\d{3})+(?!\d))", " "), F.lit("-"))


def duration(milliseconds: Column) -> Column:
    """Seconds, or minutes and seconds, or hours and minutes; ``-`` for null or negative."""
    s = F.floor(milliseconds / 1000 + 0.5).cast("long")
    m = F.floor(s / 60).cast("long")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    out = F.when(s < 60, F.concat(s.cast("string"), F.lit("s"))).when(m < 60, F.concat(m.cast("string"), F.lit("m"), two(s % 60)))
    return F.when(milliseconds.isNull() | (milliseconds < 0), "-").otherwise(out.otherwise(F.concat(F.floor(m / 60).cast("string"), F.lit("h"), two(m % 60))))


def byte_size(size: Column, units: tuple[str, ...] = ("o", "Ko", "Mo", "Go", "To")) -> Column:
    """Bytes in the largest of the units that leaves one or more; no decimals from 100 on."""
    out = F.lit(None).cast("string")
    for power, unit in reversed(list(enumerate(units))):
        n = size / float(1024**power)
        text = F.format_string("%.0f", n) if power == 0 else F.when(n >= 100, F.format_string("%.0f", n)).otherwise(F.format_string("%.1f", n))
        value = F.concat(text, F.lit(f" {unit}"))
        out = value if power == len(units) - 1 else F.when(size < float(1024 ** (power + 1)), value).otherwise(out)
    return F.coalesce(out, F.lit("-"))


def is_private_ip(address: Column) -> Column:
    """Whether an address is no public one: private, local, shared, test or multicast; true for what is no address."""
    part = lambda i: F.element_at(F.split(address, r"\."), i).try_cast("int")
    a, b = part(1), part(2)
    v4 = address.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$")
    # The reserved ranges.
    private = a.isin(0, 10, 127) | ((a == 100) & b.between(64, 127)) | ((a == 169) & (b == 254)) | ((a == 172) & b.between(16, 31)) | ((a == 192) & (b == 168)) | ((a == 198) & b.isin(18, 19)) | (a >= 224)
    v6 = F.lower(address)
    return F.when(v4, private).when(address.contains(":"), v6.isin("::", "::1") | v6.rlike("^(fc|fd|ff|fe[89ab])")).otherwise(True)
