"""Language detection (C1): character-trigram naive Bayes.

Training counts trigrams per language (one aggregate). With add-one smoothing
over the vocabulary ``V`` of all trained trigrams, the log-likelihood of a text
for language ``l`` is

    sum over its in-vocabulary trigram occurrences g of ln((c_l(g) + 1) / (T_l + V))
  = sum_g ln(c_l(g) + 1)  -  N * ln(T_l + V)

so the profile only stores *seen* (gram, language) weights ``w = ln(c + 1)`` and
one constant ``k_l = ln(T_l + V)`` per language. Both are quantised to integer
micro-units, so scores are exact integer sums: the same winner whatever the
partitioning or summation order. Detection explodes trigrams and joins a wide
profile (one column per language), then aggregates per text with map-side
partial sums. Two physical forms with identical integer results:

* profile of at most ``BROADCAST_GRAMS`` trigrams (bounded by the trigram
  alphabet, not by the corpus; checked by a count): it is broadcast and each
  text is scored in place by an Arrow UDF (per-text trigram counts), so no
  row is shuffled and no join is needed;
* larger profiles: trigrams are exploded, joined to the wide profile and
  summed per text with map-side partial aggregation.

Ties go to the greater language code; a text with no known trigram gets NULL
(the reference's "undetectable").
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.plan import bounded_broadcast, spread, write_through

SCALE = 1_000_000
# A profile with at most this many trigrams is broadcast to the Python workers
# (it is bounded by the trigram alphabet); larger ones use the relational path.
BROADCAST_GRAMS = 2_000_000

#: Trigrams that training holds uncounted in a worker, and distinct ones it holds counted, at most about.
HELD_GRAMS = 1 << 20


@cache
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    table = np.zeros(0x110000, dtype=bool)
    for m in regex.finditer(r"\p{L}+", "".join(map(chr, range(len(table))))):
        table[m.start():m.end()] = True
    return table


def gram_keys(text: str) -> np.ndarray:
    """int64 keys (21 bits per code point) of every padded-word trigram of one text.

    Same multiset as ``char_trigrams``: non-letter runs become one space, the
    text is padded, and every window whose middle code point is a letter counts.
    """
    a = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), dtype=np.uint32)
    letter = _letters()[a]
    a = np.where(letter, a, 32).astype(np.int64)  # a run of others next to a letter counts as its first or last: one space
    if len(a) < 3:
        return np.zeros(0, dtype=np.int64)
    keys = (a[:-2] << 42) | (a[1:-1] << 21) | a[2:]
    return keys[letter[1:-1]]


@cache
def _latin() -> tuple[bytes, np.ndarray]:
    """For texts in Latin-1: the code of each byte's lower-cased letter (0: no letter), and the code points of the codes."""
    low = [ord(chr(b).lower()) for b in range(256)]
    known = sorted({c for c in low if _letters()[c]})
    return bytes(known.index(c) + 1 if c in known else 0 for c in low), np.array([32, *known], dtype=np.int64)


def _latin_counts(coded: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts) of the trigrams of padded texts in the codes of ``_latin``: fewer than 64, so they are counted in place."""
    a, counts = np.frombuffer(coded, dtype=np.uint8), np.zeros(1 << 18, dtype=np.int64)
    for lo in range(0, len(a) - 2, HELD_GRAMS):
        part = a[lo:lo + HELD_GRAMS + 2]
        at = part[:-2].astype(np.intp)
        for x in (part[1:-1], part[2:]):
            at <<= 6
            at |= x
        counts += np.bincount(at, minlength=len(counts))
    cells = np.flatnonzero(counts)
    cells = cells[(cells >> 6) & 63 > 0]
    points = _latin()[1]
    return (points[cells >> 12] << 42) | (points[(cells >> 6) & 63] << 21) | points[cells & 63], counts[cells]


class GramTable:
    """Trigrams of a profile in a dense array over its own alphabet: a text's trigrams are found without sorting them."""

    #: Most values of the array (4 bytes each); a larger alphabet has none.
    MOST = 1 << 23

    def __init__(self, keys: np.ndarray):
        parts = (keys >> 42) & 0x1FFFFF, (keys >> 21) & 0x1FFFFF, keys & 0x1FFFFF
        known = np.unique(np.concatenate(parts))
        known = known[_letters()[known]]
        self.base = len(known) + 2  # 0: no letter, 1: a letter that no trigram has
        self.code = _letters().astype(np.int64)
        self.code[known] = np.arange(2, self.base)
        self.latin = bytes(self.code[ord(chr(b).lower())] for b in range(256)) if self.base <= 256 else None
        self.row = np.zeros(self.base ** 3, dtype=np.int32)  # 1 + place of the trigram, 0 without one
        a, b, c = (self.code[p] for p in parts)
        self.row[(a * self.base + b) * self.base + c] = np.arange(1, len(keys) + 1)

    @classmethod
    def of(cls, keys: np.ndarray) -> GramTable | None:
        letters = np.unique(np.concatenate([(keys >> 42) & 0x1FFFFF, (keys >> 21) & 0x1FFFFF, keys & 0x1FFFFF]))
        return cls(keys) if (len(letters) + 2) ** 3 <= cls.MOST else None

    def places(self, text: str) -> np.ndarray:
        """1 + place for every trigram occurrence of a text that the profile has; 0 for other windows."""
        try:
            coded = self.latin and text.encode("latin-1").translate(self.latin)
        except UnicodeEncodeError:
            coded = None
        if coded is None:
            text = text.lower()
            a = np.zeros(len(text) + 2, dtype=np.int64)
            self.code.take(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32), out=a[1:-1], mode="clip")
        else:
            a = np.frombuffer(b"\0%b\0" % coded, dtype=np.uint8)
        at = a[:-2].astype(np.int64)
        at *= self.base
        at += a[1:-1]
        at *= self.base
        at += a[2:]
        return self.row.take(at, mode="clip")


def encode_gram(g: str) -> int:
    a, b, c = (ord(x) for x in g)
    return (a << 42) | (b << 21) | c


def decode_gram(k: int) -> str:
    return chr((k >> 42) & 0x1FFFFF) + chr((k >> 21) & 0x1FFFFF) + chr(k & 0x1FFFFF)


def char_trigrams(col) -> Column:
    """Trigrams of each lower-cased letter run, padded with one space on each side.

    One regex pass: non-letter runs become one space, the text is padded, and
    every 3-char window whose middle char is a letter is taken (a lookahead
    finds overlapping windows). Same multiset as padding each word separately.
    """
    c = F.col(col) if isinstance(col, str) else col
    padded = F.concat(F.lit(" "), F.regexp_replace(F.lower(c), "[^\\p{L}]+", " "), F.lit(" "))
    return F.regexp_extract_all(padded, F.lit("(?=([\\p{L} ]\\p{L}[\\p{L} ]))"), 1)


@dataclass
class LanguageProfile:
    weights: DataFrame    # gram, w_<lang>... (wide; absent = 0)
    norms: DataFrame      # one row: k_<lang>...
    languages: list[str]


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, counts) of several (keys, counts), each key once."""
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    counts = np.zeros(len(keys), dtype=np.int64)
    np.add.at(counts, at, np.concatenate([c for _, c in parts]))
    return keys, counts


def _doc_gram_counts(batches):
    """Distinct trigrams and their counts per language, pre-aggregated over a partition.

    A text is read out of its Arrow batch alone, its keys are counted once ``HELD_GRAMS`` are held, and counts are
    returned when they have that many distinct keys: a worker's memory follows neither the batch nor the partition.
    Texts in Latin-1 are held as bytes and counted without sorting.
    """
    codes = _latin()[0]
    counted: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    held: dict[tuple[str, type], list] = {}
    n_held = 0

    def count():
        for (lang, kind), parts in held.items():
            new = _latin_counts(b"\0".join([b"", *parts, b""])) if kind is bytes else np.unique(np.concatenate(parts), return_counts=True)
            counted[lang] = _summed([counted[lang], new]) if lang in counted else new
        held.clear()

    def emit():
        for lang, (keys, counts) in counted.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), type=pa.string()),
                                              pa.array([decode_gram(k) for k in keys.tolist()], type=pa.string()),
                                              pa.array(counts, type=pa.int64())], names=["lang", "gram", "c"])
        counted.clear()

    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text")):
            text = text.as_py() or ""
            try:
                part = text.encode("latin-1").translate(codes)
            except UnicodeEncodeError:
                part = gram_keys(text)
            held.setdefault((lang.as_py(), type(part)), []).append(part)
            n_held += len(part)
            if n_held >= HELD_GRAMS:
                count()
                n_held = 0
                if sum(len(k) for k, _ in counted.values()) >= HELD_GRAMS:
                    yield from emit()
    count()
    yield from emit()


def train_profile(df: DataFrame, text: str = "text", lang: str = "lang") -> LanguageProfile:
    """Trigram counts per language (per-partition counts in Python, then one partial-aggregated sum)."""
    labelled = spread(df.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text")))
    per_doc = labelled.mapInArrow(_doc_gram_counts, "lang string, gram string, c long")
    counts = per_doc.groupBy("lang", "gram").agg(F.sum("c").alias("c")).checkpoint()
    languages = sorted(r[0] for r in counts.select("lang").distinct().collect())
    vocab = counts.agg(F.countDistinct("gram").alias("V"))
    totals = counts.groupBy("lang").agg(F.sum("c").alias("T"))
    k = (totals.crossJoin(F.broadcast(vocab))
         .select("lang", F.round(F.ln(F.col("T") + F.col("V")) * SCALE).cast("bigint").alias("k")))
    norms = k.groupBy().pivot("lang", languages).agg(F.first("k"))
    norms = norms.select(*[F.col(f"`{l}`").alias(f"k_{l}") for l in languages])
    w = counts.select("gram", "lang", F.round(F.ln(F.col("c") + 1) * SCALE).cast("bigint").alias("w"))
    wide = w.groupBy("gram").pivot("lang", languages).agg(F.first("w"))
    wide = wide.select("gram", *[F.coalesce(F.col(f"`{l}`"), F.lit(0)).alias(f"w_{l}") for l in languages])
    return LanguageProfile(wide.checkpoint(), norms.checkpoint(), languages)


PROFILE_VERSION = "trigram-nb-1"


def save_profile(profile: LanguageProfile, path: str) -> None:
    profile.weights.write.mode("overwrite").parquet(f"{path}/weights")
    profile.norms.write.mode("overwrite").parquet(f"{path}/norms")


def load_profile(spark, path: str) -> LanguageProfile:
    weights = spark.read.parquet(f"{path}/weights")
    langs = sorted(c[2:] for c in weights.columns if c.startswith("w_"))
    return LanguageProfile(weights, spark.read.parquet(f"{path}/norms"), langs)


def trained_profile(df: DataFrame, cache_path: str | None, text: str = "text", lang: str = "lang") -> LanguageProfile:
    """Load the profile persisted at ``cache_path`` if complete, else train, persist and load it.

    The detector is a model, fitted once and reused like a shipped language
    profile; the cache key should name the training table and PROFILE_VERSION.
    """
    spark = df.sparkSession
    if cache_path is None:
        return train_profile(df, text, lang)
    from tessera.sources.io import _exists
    if not _exists(spark, f"{cache_path}/norms"):
        save_profile(train_profile(df, text, lang), cache_path)
    return load_profile(spark, cache_path)


def language_scores(df: DataFrame, key: str | list[str], text: str, profile: LanguageProfile,
                    broadcast_rows: int = 5_000_000) -> DataFrame:
    """Per key: N (known trigram occurrences) and one integer score column per language."""
    keys = [key] if isinstance(key, str) else list(key)
    feats = df.select(*keys, F.explode(char_trigrams(text)).alias("gram"))
    joined = feats.join(bounded_broadcast(profile.weights, broadcast_rows), "gram")
    aggs = [F.count(F.lit(1)).alias("n_known")] + [F.sum(f"w_{l}").alias(f"sw_{l}") for l in profile.languages]
    summed = joined.groupBy(*keys).agg(*aggs)
    with_k = summed.crossJoin(F.broadcast(profile.norms))  # one row
    return with_k.select(*keys, "n_known", *[
        (F.col(f"sw_{l}") - F.col("n_known") * F.col(f"k_{l}")).alias(f"score_{l}") for l in profile.languages])


def _scorer(profile: LanguageProfile):
    """Broadcast the (bounded) profile and return an Arrow UDF: text -> best language, one text in Python at a time."""
    langs = profile.languages
    rows = profile.weights.collect()  # size checked by the caller
    keys = np.array([encode_gram(r["gram"]) for r in rows], dtype=np.int64)
    w = np.array([[int(r[f"w_{l}"]) for l in langs] for r in rows], dtype=np.int64).reshape(len(rows), len(langs))
    order = np.argsort(keys)
    norms = profile.norms.first()
    k = np.array([int(norms[f"k_{l}"]) for l in langs], dtype=np.int64)
    keys, w = keys[order], w[order]
    table = GramTable.of(keys)
    by_lang = np.vstack([np.zeros_like(k), w]).T.copy()  # weights of each language, at 0 that of an unknown trigram
    bc = profile.weights.sparkSession.sparkContext.broadcast((keys, w, by_lang, by_lang.astype(np.float64), k, list(langs), table))

    def summed(text: str):
        """(known trigram occurrences, their weights per language) of one text, in exact integers."""
        pk, pw, by_lang, as_doubles, _, _, table = bc.value
        if table is not None:
            at = table.places(text)
            if 4 * len(at) < len(pk) or len(at) >= 1 << 24:
                return np.count_nonzero(at), np.array([v[at].sum() for v in by_lang])
            cnt = np.bincount(at, minlength=len(pk) + 1)
            # sums of integers below 2**53, as a weight is below 2**29: exact in doubles
            return len(at) - int(cnt[0]), (as_doubles @ cnt.astype(np.float64)).astype(np.int64)
        uk, cnt = np.unique(gram_keys(text), return_counts=True)
        idx = np.minimum(np.searchsorted(pk, uk), len(pk) - 1)
        hit = pk[idx] == uk
        return int(cnt[hit].sum()), cnt[hit].astype(np.int64) @ pw[idx[hit]]

    @F.arrow_udf("string")
    def best_language(texts: pa.Array) -> pa.Array:
        pk, _, _, _, kk, ls, _ = bc.value
        out = []
        for t in texts:
            t = t.as_py()
            if t is None or len(pk) == 0:
                out.append(None)
                continue
            n, score = summed(t)
            if n == 0:
                out.append(None)
                continue
            score = score - n * kk
            j = len(ls) - 1 - int(np.argmax(score[::-1]))  # ties go to the greater language code
            out.append(ls[j])
        return pa.array(out, type=pa.string())

    # Marked nondeterministic so Catalyst evaluates it once, where it is written: a deterministic
    # UDF would be duplicated into a filter pushed below the repartition that spreads the work.
    return best_language.asNondeterministic()


def language_column(profile: LanguageProfile, text) -> Column | None:
    """The detection as a column (no shuffle) when the profile is small enough to broadcast."""
    if profile.weights.count() > BROADCAST_GRAMS:
        return None
    return _scorer(profile)(F.col(text) if isinstance(text, str) else text)


def detect_language(df: DataFrame, key: str | list[str], text: str, profile: LanguageProfile,
                    out: str = "language", detector=None) -> DataFrame:
    """(key..., ``out``) for every row of ``df``: best language of ``text``, NULL if undetectable.

    NULL and repeated keys keep their rows. ``detector``: optional ``Callable[[pd.Series], pd.Series]``
    (e.g. a library model) applied as an Arrow pandas UDF instead of the profile.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return with_language(df.select(*keys, text), keys, text, profile, out=out, detector=detector).select(*keys, out)


def _relational(df: DataFrame, text: Column, profile: LanguageProfile, out: str) -> DataFrame:
    """Detection by joins: rows are told apart by their own number, so NULL and repeated keys keep their rows."""
    rows = write_through(df.select(F.struct("*").alias("row"), text.alias("text"),
                                   F.monotonically_increasing_id().alias("rid")), "language-rows")
    scores = language_scores(rows.select("rid", "text"), "rid", "text", profile)
    langs = profile.languages
    if len(langs) == 1:
        best = F.lit(langs[0])
    else:
        best = F.greatest(*[F.struct(F.col(f"score_{l}").alias("s"), F.lit(l).alias("l")) for l in langs]).getField("l")
    picked = scores.select("rid", F.when(F.col("n_known") > 0, best).alias("found"))
    return rows.join(picked, "rid", "left").select("row.*", F.col("found").alias(out))


def with_language(df: DataFrame, key: str | list[str], text, profile: LanguageProfile, out: str = "language",
                  detector=None) -> DataFrame:
    """``df`` plus ``out``, every row once whatever its key (NULL and repeated keys too).

    A ``detector`` and a broadcastable profile work in place; a larger profile by joins on a row number.
    """
    keys = [key] if isinstance(key, str) else list(key)
    text_col = F.col(text) if isinstance(text, str) else text
    col = detector_column(detector, text_col) if detector is not None else language_column(profile, text_col)
    if col is not None:
        return spread(df, keys[0]).withColumn(out, col)
    return _relational(df, text_col, profile, out)


def detector_column(detector, text: Column) -> Column:
    """A user's ``Callable[[pd.Series], pd.Series]`` as a column; each use is one call per row."""
    return F.pandas_udf(detector, "string").asNondeterministic()(text)
