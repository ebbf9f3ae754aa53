"""Document fingerprints: a homomorphic multiset hash over paragraphs, with DataFrame functions only.

The fingerprint of a text is a vector of 60-bit words, the sum over its paragraphs (the text split at line
feeds) of a wide vector hashed from each.  It has three parts:

* the number of runs: a paragraph's words (joined by single spaces) cut after every word whose hash is 0 modulo ``RUN``,
  so that an inserted or deleted word changes its own run only and all others stay aligned,
* ``EXACT_SEEDS`` sums modulo 2**60 of seeded 64-bit hashes of the whole paragraphs: equality, and
* ``SKETCH_SEEDS`` x 20 words of three 20-bit lanes, sums modulo 2**19 (no carry leaves a lane) of one hash bit for every run:
  likeness.

Sums do not depend on the order of paragraphs, and a paragraph is inserted or deleted by adding or subtracting
its vector (``add``, ``subtract``); both stay modulo the powers.  Of a text and its paragraphs in another order
the fingerprints are equal; other texts differ with probability 1 - 2**-240.  The hash is not keyed, so this
is no defence against forgers.

``likeness`` reads every lane as a random-sign sketch (twice the bit sum less the number of runs).  The mean
square of the difference of two sketches estimates the size of the multisets' difference; likeness is one less
that size over the sum of the sizes, cut to 0..1, with a standard error of about 12 % of the difference.

Defined results.  Null text: as the empty text (one empty paragraph, no runs).  Two fingerprints without runs
are alike 1 if equal, else 0.  Documents are ordered by ``doc_id`` (null first), then text; repeated rows are
each other's next document.  A single document is its own next one.  Empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranges import quantile_cuts, range_bucket
from .common import shuffle_partitions

RUN = 8                                       # mean words of a run
EXACT_SEEDS = (101, 102, 103, 104)
SKETCH_SEEDS = (201, 202)
_SHIFTS = 20                                  # words a seed; three lanes of 20 bits each
_MASK = 1 | 1 << _SHIFTS | 1 << 2 * _SHIFTS
_WORD = (1 << 60) - 1
_LANE = (1 << _SHIFTS - 1) - 1                # a lane counts modulo 2**19; its top bit takes the carry and is cleared
_LANES = _LANE * _MASK
_WORDS = r"\n|[^\x20\x09-\x0D]+"


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _sum(a: Column, b: Column) -> Column:
    return (a + b).bitwiseAND(_long(_WORD))


def with_vector(df: DataFrame, text: str, name: str) -> DataFrame:
    """Append the fingerprint vector of a text column, as ``array<bigint>``.

    The runs are a column of their own, so that the patterns are matched once a text.
    """
    words = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(_WORDS), F.lit(0))
    ended = F.transform(words, lambda w: F.concat(w, F.when(F.pmod(F.xxhash64(w), F.lit(RUN)) == 0, "\n").otherwise(" ")))
    df = df.withColumn("__runs", F.regexp_extract_all(F.array_join(ended, ""), F.lit(r"[^\x20\n][^\n]*"), F.lit(0)))
    paragraphs = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    shifts = F.array(*[F.lit(j) for j in range(_SHIFTS)])
    zeros = F.array(*[_long(0)] * _SHIFTS)

    def exact(seed: int) -> Column:
        return F.aggregate(paragraphs, _long(0), lambda total, p: _sum(total, F.xxhash64(F.lit(seed), p).bitwiseAND(_long(_WORD))))

    def sketch(seed: int) -> Column:
        hashes = F.transform("__runs", lambda run: F.xxhash64(run, F.lit(seed)))
        return F.aggregate(hashes, zeros, lambda total, h: F.zip_with(
            total, shifts, lambda t, j: (t + F.call_function("shiftright", h, j).bitwiseAND(_long(_MASK))).bitwiseAND(_long(_LANES))))
    return df.withColumn(name, F.concat(F.array(F.size("__runs").cast("long"), *map(exact, EXACT_SEEDS)), *map(sketch, SKETCH_SEEDS))).drop("__runs")


def _lanes(word: Column) -> list[Column]:
    return [F.shiftright(word, _SHIFTS * i).bitwiseAND(_long(_LANE)) for i in range(3)]


def _pack(lanes: list[Column]) -> Column:
    kept = [x.bitwiseAND(_long(_LANE)) for x in lanes]
    return kept[0].bitwiseOR(F.shiftleft(kept[1], _SHIFTS)).bitwiseOR(F.shiftleft(kept[2], 2 * _SHIFTS))


def _merge(a: Column, b: Column, sign: int) -> Column:
    head = 1 + len(EXACT_SEEDS)
    n = F.slice(F.zip_with(a, b, lambda x, y: x + y * sign), 1, 1)
    exact = F.zip_with(F.slice(a, 2, head - 1), F.slice(b, 2, head - 1), lambda x, y: (x + y * sign).bitwiseAND(_long(_WORD)))
    size = _SHIFTS * len(SKETCH_SEEDS)
    lanes = F.zip_with(F.slice(a, head + 1, size), F.slice(b, head + 1, size),
                       lambda x, y: _pack([p + q * sign for p, q in zip(_lanes(x), _lanes(y))]))
    return F.concat(n, exact, lanes)


def add(a: Column, b: Column) -> Column:
    """Fingerprint of the union of two multisets of paragraphs."""
    return _merge(a, b, 1)


def subtract(a: Column, b: Column) -> Column:
    """Fingerprint of ``a`` without the paragraphs of ``b``."""
    return _merge(a, b, -1)


def digest(v: Column) -> Column:
    """The vector as text: hexadecimal words joined by dots."""
    return F.array_join(F.transform(v, lambda x: F.lower(F.hex(x))), ".")


def likeness(a: Column, b: Column) -> Column:
    """Estimated share (0 to 1) of runs that two fingerprints have in common."""
    head, size = 1 + len(EXACT_SEEDS), _SHIFTS * len(SKETCH_SEEDS)
    na, nb = F.element_at(a, 1), F.element_at(b, 1)
    between = F.zip_with(F.slice(a, head + 1, size), F.slice(b, head + 1, size), lambda x, y: F.struct(x.alias("x"), y.alias("y")))

    def add_squares(total: Column, pair: Column) -> Column:
        for p, q in zip(_lanes(pair["x"]), _lanes(pair["y"])):
            d = (2 * (p - q) - (na - nb) + _LANE + 1).bitwiseAND(_long(2 * _LANE + 1)) - (_LANE + 1)  # modulo 2**20, around 0
            total = total + (d * d).cast("double")
        return total
    apart = F.aggregate(between, F.lit(0.0), add_squares) / (3 * size)
    alike = F.greatest(F.lit(0.0), 1 - apart / (na + nb))
    return F.when(a == b, 1.0).when(na + nb == 0, 0.0).otherwise(alike)


def with_next(docs: DataFrame, carried: list[str], buckets: int | None = None) -> DataFrame:
    """``doc_id``, ``carried`` and ``next_<c>`` of every carried column: those of the next document by id (then by
    the carried columns), or of the first document after the last.

    Ids are cut into range buckets at approximate quantiles; each bucket also gets a copy of the first row of
    the bucket after it, so one shuffle and a window inside the buckets suffice.
    """
    spark = docs.sparkSession
    low = -(1 << 63)
    docs = docs.select("doc_id", *carried, F.coalesce("doc_id", F.lit(low)).alias("__key"))
    buckets = buckets or 16 * shuffle_partitions(spark)
    placed = docs.withColumn("__bucket", range_bucket(F.col("__key"), quantile_cuts(docs, "__key", buckets)))
    heads = [(r["__bucket"], r["head"]) for r in  # one row a bucket
             placed.groupBy("__bucket").agg(F.min("__key").alias("head")).orderBy("__bucket").collect()]
    before = {heads[i][1]: heads[i - 1][0] for i in range(len(heads))}
    firsts = spark.createDataFrame([(k, v) for k, v in before.items()], "__key long, __previous int")
    copies = (placed.join(F.broadcast(firsts), "__key", "left")
              .withColumn("__to", F.explode(F.when(F.col("__previous").isNull(), F.array(F.struct(F.col("__bucket").alias("b"), F.lit(False).alias("copy"))))
                                            .otherwise(F.array(F.struct(F.col("__bucket").alias("b"), F.lit(False).alias("copy")),
                                                               F.struct(F.col("__previous").alias("b"), F.lit(True).alias("copy")))))))
    rows = copies.select("doc_id", *carried, "__key", F.col("__to.b").alias("__b"), F.col("__to.copy").alias("__copy"))
    order = Window.partitionBy("__b").orderBy("__copy", "__key", *carried)
    return rows.select("doc_id", *carried, "__copy", *[F.lead(c).over(order).alias(f"next_{c}") for c in carried]).where("not __copy").drop("__copy")


def edited_text(text: Column, following: Column) -> Column:
    """``text`` with its last quarter of code points replaced by the first as many of ``following``."""
    n = F.length(text)
    k = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - k), F.substring(following, F.lit(1), k))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text, of its edited text and their likeness (see the module's text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = with_next(with_vector(docs, "text", "vector"), ["text", "vector"])
    rows = rows.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    rows = with_vector(rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "vector", "next_vector", "edited"), "edited", "edited_vector")
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       digest(F.col("vector")).alias("fingerprint"), digest(F.col("edited_vector")).alias("edited_fingerprint"),
                       likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
                       likeness(F.col("vector"), F.col("next_vector")).alias("near_next"))
