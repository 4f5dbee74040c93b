"""Document fingerprints: a homomorphic multiset hash of a text's paragraphs.

A fingerprint is a vector of lanes, each a sum modulo 2**60:

* 4 identity lanes: the paragraphs (lines) hashed with 4 seeds.  240 bits; equal
  for texts with the same multiset of paragraphs, whatever their order.
* 21 likeness lanes of 3 counters each: every paragraph is cut into phrases, a
  phrase hashes to 63 bits, and the counters add up the bits.  Seen as +1/-1
  sums, two vectors have the cosine of the texts' phrase multisets, with a
  standard error of about 1/8.
* 1 lane counting the phrases.

Paragraphs are hashed independently, so fingerprints are additive: the
fingerprint of two texts joined by a line break is ``add`` of theirs, and
``remove`` takes a paragraph out again without reading the rest.  The hashes are
not cryptographic: they tell texts apart, they do not resist an adversary.

Defined results: a null text is the empty text (one empty paragraph, no
phrase).  Equal fingerprints have likeness 1; otherwise a text without phrases
has likeness 0.  A counter beyond 2**20 phrases carries into its neighbour:
still additive, the likeness gets coarser.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MASK = (1 << 60) - 1
TRIPLE = 1 | 1 << 20 | 1 << 40  # one counter per 20 bits
SEEDS, LANES = 4, 21
FIELD = (1 << 20) - 1
# A phrase ends at white space after a non-letter or one of these letters,
# wherever the text puts it; a line break always ends one.
PHRASE = r"(?<=[\P{L}dsnrelDSNREL])[ \t]+|\n"


def _sum(values: Column, term=lambda h: h) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, h: (a + term(h)).bitwiseAND(F.lit(MASK)))


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``: the lanes of ``text`` as array<long> (never null)."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.split(t, "\n", -1)
    phrases = F.filter(F.split(t, PHRASE, -1), lambda p: p != "")
    df = df.withColumn("_lines", lines).withColumn("_hashes", F.transform(phrases, lambda p: F.xxhash64(p)))

    def seeded(seed: int) -> Column:
        return F.transform("_lines", lambda p: F.xxhash64(F.lit(seed), p).bitwiseAND(F.lit(MASK)))

    def bits(j: int) -> Column:
        return _sum(F.col("_hashes"), lambda h: F.shiftrightunsigned(h, j).bitwiseAND(F.lit(TRIPLE)))

    identity = [_sum(seeded(s)) for s in range(SEEDS)]
    counters = [bits(j) for j in range(20)]
    counters.append(_sum(F.col("_hashes"), lambda h: F.shiftrightunsigned(h, 60).bitwiseAND(F.lit(1))
                         + F.shiftleft(F.shiftrightunsigned(h, 61).bitwiseAND(F.lit(1)), 20)
                         + F.shiftleft(F.shiftrightunsigned(h, 62).bitwiseAND(F.lit(1)), 40)))
    return df.withColumn(out, F.array(*identity, *counters, F.size("_hashes").cast("long"))).drop("_lines", "_hashes")


def add(a: Column, b: Column) -> Column:
    """Fingerprint of both texts' paragraphs together."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(F.lit(MASK)))


def remove(a: Column, b: Column) -> Column:
    """Fingerprint of a's paragraphs without b's."""
    return F.zip_with(a, b, lambda x, y: (x - y).bitwiseAND(F.lit(MASK)))


def as_text(lanes: Column) -> Column:
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), 15, "0")), "")


def _signs(lanes: Column) -> list[Column]:
    """The likeness vector: 2 * counter - phrases, for each counter."""
    n = F.element_at(lanes, SEEDS + LANES + 1)
    return [F.shiftrightunsigned(F.element_at(lanes, SEEDS + 1 + j), 20 * k).bitwiseAND(F.lit(FIELD)) * 2 - n
            for j in range(LANES) for k in range(3)]


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: estimated cosine of the two phrase multisets, 1 if equal."""
    x, y = (F.array(*_signs(c)).cast("array<double>") for c in (a, b))
    dot = F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    size = [F.aggregate(v, F.lit(0.0), lambda s, p: s + p * p) for v in (x, y)]
    cos = F.when((size[0] > 0) & (size[1] > 0), dot / F.sqrt(size[0] * size[1])).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cos)))


def with_next(df: DataFrame, id_col: str, carry: list[str], every: int = 64, most: int = 65536) -> DataFrame:
    """Add ``next_<c>`` of the row that follows in descending id (after the last
    row: the first), without sorting the table in one task.

    One id in ``every`` (by hash; fewer once that would pass ``most``) is a
    border.  Rows fall into the ranges between borders; the rows of a border id
    also visit the range below, where they are the next of its last row.  Rows
    repeated under an id follow each other by their carried columns, descending;
    rows without an id come last."""
    ids = df.select(id_col).filter(F.col(id_col).isNotNull())
    n, top = ids.agg(F.count("*"), F.max(id_col)).first()
    m = max(every, n // most + 1)
    borders = sorted({r[0] for r in ids.filter(F.pmod(F.xxhash64(id_col), F.lit(m)) == 0).distinct().collect()} | ({top} if n else set()))
    listed = F.split(F.lit(",".join(map(str, borders))), ",").cast("array<bigint>") if borders else F.array().cast("array<bigint>")
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(borders).bit_length()))))
    below = F.aggregate(steps, F.lit(0), lambda at, s: F.when(
        (at + s <= len(borders)) & (F.get(listed, at + s - 1) < F.col(id_col)), at + s).otherwise(at))
    df = df.withColumn("_range", F.coalesce(below, F.lit(0)) if borders else F.lit(0))
    is_border = F.coalesce(F.get(listed, F.col("_range")) == F.col(id_col), F.lit(False))
    home = F.struct(F.col("_range").alias("r"), F.lit(False).alias("guest"))
    visit = F.struct(F.when(F.col("_range") + 1 < len(borders), F.col("_range") + 1).otherwise(0).alias("r"), F.lit(True).alias("guest"))
    df = df.withColumn("_at", F.explode(F.when(is_border, F.array(home, visit)).otherwise(F.array(home))))
    df = df.withColumn("_r", F.col("_at.r")).withColumn("_guest", F.col("_at.guest")).drop("_at", "_range")
    w = Window.partitionBy("_r").orderBy("_guest", F.desc(id_col), *(F.desc(c) for c in carry))
    df = df.withColumns({f"next_{c}": F.lead(c).over(w) for c in carry})
    return df.filter("NOT _guest").drop("_r", "_guest")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text, and the text with its last third replaced by the
    beginning of the next document's; compare it with both."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    df = with_next(with_fingerprint(base, "text", "fp"), "doc_id", ["text", "fp"])
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - third),
                      F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), third))
    df = df.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("edited", edited)
    df = with_fingerprint(df.drop("text", "next_text"), "edited", "efp")
    return df.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("fp")).alias("fingerprint"),
                     as_text(F.col("efp")).alias("edited_fingerprint"), likeness(F.col("fp"), F.col("efp")).alias("near_edited"),
                     likeness(F.col("fp"), F.coalesce("next_fp", F.col("fp"))).alias("near_next"))


def combine(lanes: list[Column]) -> Column:
    """Fingerprint of several texts' paragraphs together."""
    return reduce(add, lanes)
