"""Benchmark decontamination by a prefix-filtered join, in DataFrame operations.

Texts are words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the A-Z-lowered text. A
window is a run of 10 words of a benchmark item (the whole item if it has
fewer); a document word inside any occurrence of a window is hit.

The shingles of a window are its word pairs, ordered by their count over all
documents. A document holds a window only if it holds every shingle of it, so
the prefix that the join needs is the rarest one. Its place in the document and
in the window gives the only place where the window can begin; that must lie
inside the document, and the words there are compared with the window's.

The texts are cut into words once: that scan keeps, of each document, the
number of its words and the places of the shingles that may be a window's, by a
sieve of 64 bits per shingle of the benchmark (at most SIEVE_BITS; a full sieve
lets more places pass and loses none). Counting, joining and the bounds work on
those places; only texts with a candidate left are cut again, once per distinct
text, to compare words.

Defined results: null and empty texts have no words and no hits; null item ids
hit but are not listed; repeated rows each give their own row; an empty
benchmark hits nothing; an empty table gives no rows; columns of the same names
as the added ones are replaced, other columns are kept as asked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .graph import discard, few, materialize

WINDOW_WORDS = 10
WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
#: Largest sieve, in bits (8 MB on every worker).
SIEVE_BITS = 1 << 26
#: Texts are known by two 64-bit hashes.
KEY = ["_decon_1", "_decon_2"]


def words(text: str) -> Column:
    low = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")),
                      "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(1))


def _token(c: str, i: str, pairs: bool) -> str:
    return f"xxhash64(get({c}, {i}), get({c}, {i} + 1))" if pairs else f"xxhash64(get({c}, {i}))"


def _places(c: str, pairs: bool) -> str:
    """0, 1, 2 ... for the shingles of a list of words."""
    return f"slice(sequence(0, size({c})), 1, greatest(size({c}) - {1 if pairs else 0}, 0))"


def _windows(benchmark: DataFrame, size: int) -> DataFrame:
    """One row per distinct window: w, window, length, items, tokens (word pairs, of one word the word)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words("text").alias("words")).filter(
        "size(words) > 0")
    windows = items.select("item_id", F.explode(F.expr(
        f"transform(sequence(0, greatest(size(words) - {size}, 0)), i -> slice(words, i + 1, {size}))")).alias("window"))
    windows = windows.groupBy("window").agg(F.collect_set("item_id").alias("items"))
    tokens = {p: F.expr(f"transform({_places('window', p)}, i -> {_token('window', 'i', p)})") for p in (True, False)}
    return materialize(benchmark.sparkSession, windows.select(
        F.monotonically_increasing_id().alias("w"), "window", F.size("window").alias("length"), "items",
        F.when(F.size("window") > 1, tokens[True]).otherwise(tokens[False]).alias("tokens")), "decontaminate-windows")


def _sieve(tokens: DataFrame) -> tuple[Column, int]:
    """Bits of the tokens by their upper bits, as one array of longs, and how far to shift a token."""
    bits = 1 << max(16, min(SIEVE_BITS.bit_length() - 1, (64 * tokens.count()).bit_length()))
    shift = 64 - (bits.bit_length() - 1)
    place = F.shiftrightunsigned("token", shift)
    set_bits = tokens.groupBy(F.shiftright(place, 6).alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, int(shiftrightunsigned(token, {shift}) & 63))")).alias("b"))
    every = tokens.sparkSession.range(bits >> 6).join(set_bits, F.col("id") == F.col("at"), "left")
    return every.agg(F.expr("transform(array_sort(collect_list(struct(id, coalesce(b, 0L) as b))), x -> x.b)")).scalar(), shift


def _hits(c: str, sieve: str, shift: int, pairs: bool) -> Column:
    """The places of a list of words whose shingle passes the sieve, with the shingle."""
    token = _token(c, "i", pairs)
    place = f"shiftrightunsigned({token}, {shift})"
    return F.expr(f"transform(filter({_places(c, pairs)}, i -> "
                  f"getbit(get({sieve}, int(shiftright({place}, 6))), int({place} & 63)) = 1), "
                  f"i -> struct(i as pos, {token} as token))")


def _key() -> dict[str, Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return {KEY[0]: F.xxhash64(text), KEY[1]: F.xxhash64(F.lit("decontaminate"), text)}


def _scan(docs: DataFrame, windows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` of all documents, their key, n_words, and the places that pass the sieves."""
    base = docs.select(*keep, *[c.alias(k) for k, c in _key().items()], words("text").alias("_decon_words"))
    found = []
    for pairs in (True, False):
        tokens = windows.filter("length > 1" if pairs else "length = 1").select(F.explode("tokens").alias("token")).distinct()
        if tokens.isEmpty():
            continue
        sieve, shift = _sieve(tokens)
        base = base.withColumn(f"_decon_sieve{len(found)}", sieve)
        found.append(_hits("_decon_words", f"_decon_sieve{len(found)}", shift, pairs))
    none = F.array().cast("array<struct<pos:int,token:bigint>>")
    return materialize(docs.sparkSession, base.select(
        *keep, *KEY, F.size("_decon_words").cast("long").alias("n_words"),
        (F.concat(*found) if found else none).alias("_decon_hits")), "decontaminate-scan")


def find_hits(docs: DataFrame, benchmark: DataFrame, keep: list[str], size: int = WINDOW_WORDS
              ) -> tuple[DataFrame, DataFrame]:
    """The scan of all documents, and per text with a hit: key, n_hit and items (sorted ids as strings)."""
    spark = docs.sparkSession
    windows = _windows(benchmark, size)
    scan = _scan(docs, windows, keep)
    places = scan.select(*KEY, "n_words", F.explode("_decon_hits").alias("h")).select(*KEY, "n_words", "h.pos", "h.token")
    tokens = windows.select("w", "length", F.posexplode("tokens").alias("offset", "token"))
    counts = places.join(tokens.select("token").distinct(), "token").groupBy("token").count()
    # a shingle that no document has rules its window out
    probes = (tokens.join(counts, "token").groupBy("w", "length").agg(
        F.count_distinct("offset").alias("met"), F.min(F.struct("count", "offset", "token")).alias("t"))
        .filter("met = greatest(length - 1, 1)")
        .select("w", "length", F.col("t.offset").alias("offset"), F.col("t.token").alias("token")))
    probes = materialize(spark, probes, "decontaminate-probes")
    begins = materialize(spark, places.join(probes, "token").withColumn("start", F.expr("pos - offset"))
                         .filter("start >= 0 and start + length <= n_words").select(*KEY, "start", "w").distinct(),
                         "decontaminate-candidates")
    wanted = few(begins.select(*KEY).distinct())
    texts = (docs.withColumns(_key()).join(wanted, KEY, "left_semi").select(*KEY, "text").dropDuplicates(KEY)
             .select(*KEY, words("text").alias("words")))
    held = (begins.join(windows.select("w", "window", "length", "items"), "w").join(texts, KEY)
            .filter("slice(words, start + 1, length) = window"))
    per = held.groupBy(*KEY).agg(F.collect_set(F.struct("start", "length")).alias("at"),
                                 F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    per = materialize(spark, per.select(*KEY, "items", F.expr(
        "size(array_distinct(flatten(transform(at, x -> sequence(x.start, x.start + x.length - 1)))))").cast("long").alias("n_hit")),
        "decontaminate-hits")
    discard(begins, probes, windows)
    return scan, per


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns) of ``docs`` with n_words, n_hit, items (sorted ids as strings) and contaminated."""
    new = ("n_words", "n_hit", "items", "contaminated")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    scan, per = find_hits(docs, benchmark, keep, size)
    return (scan.drop("_decon_hits").join(per, KEY, "left")
            .withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")),
                          "items": F.coalesce("items", F.array().cast("array<string>"))})
            .withColumn("contaminated", F.col("n_hit") > 0).select(*keep, *new))


def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark."""
    scan, per = find_hits(docs, benchmark, [], size)
    discard(scan)
    return docs.withColumns(_key()).join(few(per.select(*KEY)), KEY, "left_anti").select(*docs.columns)
