"""Column builders for text: all JVM-side expressions, usable inside any plan.

Regex notes (Python ``re`` semantics are the target):
* Python ``\\s`` on ``str`` is Unicode whitespace plus U+001C..U+001F; Java needs
  ``(?U)`` for the Unicode part and the explicit range for the rest.
* Python ``.`` excludes only ``\\n``; Java ``.`` also excludes ``\\r``, U+0085,
  U+2028/9 unless UNIX_LINES ``(?d)`` is on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's whitespace class, as a Java character-class body (needs (?U)).
PY_WS = "\\s\\x1c-\\x1f"
# The same characters one by one.
PY_WS_CHARS = "".join(map(chr, (*range(0x9, 0xe), *range(0x1c, 0x21), 0x85, 0xa0, 0x1680, *range(0x2000, 0x200b),
                                0x2028, 0x2029, 0x202f, 0x205f, 0x3000)))


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.btrim(_c(col), F.lit(PY_WS_CHARS))  # looks at the ends only


def strip_tags(col) -> Column:
    """Delete every non-greedy ``<...>`` run on one line."""
    return F.regexp_replace(_c(col), "(?d)<.*?>", "")


def strip_special(col) -> Column:
    """Delete every char outside ``[a-zA-Z0-9\\s]`` (Python ``\\s``), no space inserted (C4)."""
    return F.regexp_replace(_c(col), f"(?U)[^a-zA-Z0-9{PY_WS}]", "")


def concat_content(col, sep: str = " ") -> Column:
    """Join a chunk list into one string."""
    return F.array_join(_c(col), sep)


def sha_word(hex_col: Column, i: int) -> Column:
    """The i-th 32-bit word (0-based) of a hex digest, as bigint."""
    return F.conv(F.substring(hex_col, 8 * i + 1, 8), 16, 10).cast("bigint")


def hash_mod(hex_col: Column, modulus: int = 10**8) -> Column:
    """``int(hexdigest, 16) % modulus`` by Horner over eight 32-bit words (all in bigint)."""
    acc = F.lit(0).cast("bigint")
    for i in range(8):
        acc = (acc * F.lit(4294967296) + sha_word(hex_col, i)) % F.lit(modulus)
    return acc


def content_id(col) -> Column:
    """``int(sha256(str(s).lower().strip()), 16) % 10**8``."""
    return hash_mod(F.sha2(py_strip(F.lower(_c(col))), 256))


def content_key(col) -> Column:
    """Full 256-bit key of the same normalised text; join on this, not on the 10^8 id."""
    return F.sha2(py_strip(F.lower(_c(col))), 256)


def word_count(col) -> Column:
    """``len(s.split())``: number of maximal non-whitespace runs."""
    return F.regexp_count(_c(col), F.lit(f"(?U)[^{PY_WS}]+"))


def to_list_literal(col) -> Column:
    """Render an array<string> as a Python list literal (single-quoted, escaped)."""
    def esc(x):
        x = F.replace(x, F.lit("\\"), F.lit("\\\\"))
        x = F.replace(x, F.lit("'"), F.lit("\\'"))
        x = F.replace(x, F.lit("\n"), F.lit("\\n"))
        x = F.replace(x, F.lit("\r"), F.lit("\\r"))
        x = F.replace(x, F.lit("\t"), F.lit("\\t"))
        return F.concat(F.lit("'"), x, F.lit("'"))

    return F.concat(F.lit("["), F.array_join(F.transform(_c(col), esc), ", "), F.lit("]"))


def parse_list_literal(col) -> Column:
    """Python list-of-strings literal -> array<string>; unparseable -> NULL (B2).

    ``\\xNN`` escapes (not JSON) are rewritten to ``\\u00NN`` unless the backslash
    is itself escaped. Nothing is evaluated.
    """
    fixed = F.regexp_replace(_c(col), r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})", "$1\\\\u00$2")
    return F.from_json(fixed, "array<string>", {
        "allowSingleQuotes": "true",
        "allowBackslashEscapingAnyCharacter": "true",
        "allowUnquotedControlChars": "true",
        "mode": "PERMISSIVE",
    })


# --- texts whose characters are looked up byte by byte in Arrow tasks -----------

def unless_ascii(col, otherwise: Column) -> Column:
    """An ASCII text as it is, ``otherwise`` for any other: what ``byte_table`` does is left to the task that reads it."""
    c = _c(col)
    return F.when((F.octet_length(c) == F.length(c)) & F.is_valid_utf8(c), c).otherwise(otherwise)


def byte_table(also: str = "") -> bytes:
    """For ``bytes.translate``: A-Z lower-cased, ASCII beside letters, digits and ``also`` to a space, other bytes as they are.

    A text that is lower-cased and spaced already stays the same.
    """
    kept = {*map(ord, also), *range(0x30, 0x3a), *range(0x61, 0x7b), *range(0x80, 0x100)}
    return bytes(b + 32 if 0x41 <= b <= 0x5a else b if b in kept else 0x20 for b in range(256))


def translated(texts, table: bytes):
    """An Arrow array of texts, nulls as empty texts, each byte through ``table``."""
    import numpy as np
    import pyarrow as pa

    texts = texts.cast(pa.string()).fill_null("")
    _, ends, data = texts.buffers()
    if data is None or not len(texts):
        return texts
    at = np.frombuffer(ends, dtype=np.int32, count=len(texts) + 1, offset=4 * texts.offset)
    held = data.slice(int(at[0]), int(at[-1] - at[0])).to_pybytes().translate(table)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(at - at[0]), pa.py_buffer(held))


# --- fuzzy-matching normalisation (token-set ratio, D3) --------------------------

def fuzz_normalize(col) -> Column:
    """Drop chars U+0080..U+00FF, non-word chars -> space, lower, strip."""
    s = F.regexp_replace(_c(col), "[\\x{80}-\\x{ff}]", "")
    s = F.regexp_replace(s, "[^\\p{L}\\p{N}_]", " ")
    return F.trim(F.lower(s))


def token_set(col) -> Column:
    """Distinct whitespace tokens of an already normalised string, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.split(_c(col), " +"), lambda t: t != "")))


def joined_length(n_tokens: Column, len_sum: Column) -> Column:
    """Length of ``' '.join(tokens)`` from the token count and the sum of token lengths."""
    return F.when(n_tokens > 0, len_sum + n_tokens - 1).otherwise(F.lit(0))


# --- default encoder tokens and entities ----------------------------------------

def word_tokens(col) -> Column:
    """Lower-cased letter/digit runs (default encoder, overlap tests)."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit("[\\p{L}\\p{N}]+"), 0)


def spaced_tokens(col) -> Column:
    """The text of which ``word_tokens`` are the parts between spaces (parts may be empty)."""
    return F.regexp_replace(F.lower(_c(col)), "[^\\p{L}\\p{N}]", " ")


def entities(col) -> Column:
    """Default entity extractor: distinct letter/digit runs that start upper-case (length >= 2)
    or are all digits."""
    toks = F.regexp_extract_all(_c(col), F.lit("[\\p{L}\\p{N}]+"), 0)
    return F.array_distinct(F.filter(toks, lambda t: t.rlike("^(\\p{Lu}[\\p{L}\\p{N}]+|\\p{N}+)$")))


def collection_name(model, splitter, env) -> Column:
    """``cleantech-{model}-{splitter}_{env}`` lower-cased, ' ', '/', ':', '-' -> '_' (A10)."""
    raw = F.concat(F.lit("cleantech-"), _c(model), F.lit("-"), _c(splitter), F.lit("_"), _c(env))
    return F.translate(F.lower(raw), " /:-", "____")
