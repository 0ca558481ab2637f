"""Document fingerprints by one-permutation MinHash.

Each distinct five-word shingle is hashed once; the high bits choose one of
`BINS` bins and the bin keeps its smallest value. An empty bin takes the value
of a bin that is not empty, found by a probe sequence of its own (optimal
densification: donors of different empty bins are independent), and the
fingerprint stores the low `BITS` bits of every bin. Values of different
shingles agree in those bits by chance with probability 2^-BITS, which
`likeness` takes out: (matches/BINS - 2^-BITS) / (1 - 2^-BITS), at least 0.

Cases: null text is empty text; a text of fewer than five words is one shingle
(so is a text without words, and two such texts are alike); equal texts have
equal fingerprints; the next document goes by doc_id (null first), then a hash
of the text; rows that repeat both get the same result each and count once in
the order; a single document is its own next; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import let, query, row_key, successors, table, words
from segloom.runtime import cut

BINS = 256
BITS = 8
SHINGLE = 5
_VALUE = 48  # bits of a hash that stay as the value
_PROBES = 16


def _walks() -> list[tuple[int, int]]:
    """(start, odd step) of every bin's probe sequence; an odd step comes by all bins (their number is a power of two)."""
    mixed = [int.from_bytes(hashlib.blake2b(j.to_bytes(4, "big"), digest_size=8).digest(), "big") for j in range(BINS)]
    return [(x % BINS, (x >> 32) % BINS | 1) for x in mixed]


def _constant(rows: list[list[int]]) -> Column:
    return F.expr("array(" + ",".join("array(" + ",".join(map(str, r)) + ")" for r in rows) + ")")


def _probes() -> Column:
    """For every bin: the bins its first attempts ask, then its start, then the inverse of its step."""
    return _constant([[(s + a * t) % BINS for a in range(_PROBES)] + [s, pow(t, -1, BINS)] for s, t in _walks()])


def _far(firsts: Column, probe: Column) -> Column:
    """The value found by following a probe sequence to its end: of the filled bin with the smallest attempt."""
    attempt = lambda c: F.pmod((_bin(c) - probe[_PROBES]) * probe[_PROBES + 1], F.lit(BINS))
    return F.array_min(F.transform(firsts, lambda c: F.struct(attempt(c).alias("a"), c.alias("c"))))["c"]


def _bin(code: Column) -> Column:
    return F.shiftright(code, _VALUE)


def signature(text: Column) -> Column:
    """`BINS` values of a text, all filled."""

    def hashes(w: Column) -> Column:
        some = F.transform(F.sequence(F.lit(1), F.size(w) - SHINGLE + 1), lambda i: F.xxhash64(F.slice(w, i, SHINGLE)))
        return F.when(F.size(w) < SHINGLE, F.array(F.xxhash64(w))).otherwise(some)

    def codes(h: Column) -> Column:
        return F.sort_array(F.transform(h, lambda x: F.shiftrightunsigned(x, 64 - (_VALUE + (BINS - 1).bit_length()))))

    def smallest(c: Column) -> Column:
        return F.filter(c, lambda x, i: (i == 0) | (_bin(x) != _bin(c[i - 1])))

    def dense(c: Column) -> Column:
        empty = lambda n: F.array_repeat(F.lit(None).cast("long"), n.cast("int"))
        gap = lambda x, i: F.concat(empty(_bin(x) - F.when(i == 0, F.lit(-1)).otherwise(_bin(c[i - 1])) - 1), F.array(x))
        return F.concat(F.flatten(F.transform(c, gap)), empty(F.lit(BINS - 1) - _bin(F.element_at(c, -1))))

    def filled(c: Column, d: Column, probes: Column) -> Column:
        def one(x: Column, j: Column) -> Column:
            asked = [F.get(d, F.get(F.get(probes, j), F.lit(a))) for a in range(_PROBES)]
            return F.coalesce(x, *asked, _far(c, F.get(probes, j)))

        return F.transform(d, one)

    first = let(let(let(words(F.lower(F.coalesce(text, F.lit("")))), hashes), codes), smallest)
    return let(_probes(), lambda probes: let(first, lambda c: let(dense(c), lambda d: filled(c, d, probes))))


def packed(values: Column) -> Column:
    """Low bits of the values, as bytes."""
    two = lambda v: F.lpad(F.hex(v.bitwiseAND(2**BITS - 1)), 2, "0")
    return F.unhex(F.array_join(F.transform(values, two), ""))


def fingerprint(text: Column) -> Column:
    return packed(signature(text))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets behind two packed fingerprints, 0 to 1."""
    places = F.sequence(F.lit(1), F.lit(BINS * BITS // 8))
    same = F.size(F.filter(places, lambda i: F.substr(a, i, F.lit(1)) == F.substr(b, i, F.lit(1))))
    chance = 2.0**-BITS
    return F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1.0 - chance))


def edited_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, its key, the next document's key, and the text whose last quarter is the next document's beginning."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("_key", row_key("doc_id", "text"))
    order = rows.select("doc_id", "_key", F.floor(F.length("text") / 4).alias("_take")).distinct()
    order = cut(successors(order, ["doc_id", "_key"], ["_key", "_take"]).select("doc_id", "_key", "_take", "next__key", "prev__key", "prev__take"))
    # Both joins deal out the same two columns by the same key, so texts are shuffled once.
    own = rows.select("_key", "text")
    heads = own.join(order, "_key").select(F.col("prev__key").alias("_key"), F.substring("text", F.lit(1), F.col("prev__take").cast("int")).alias("_head"))
    heads = heads.groupBy("_key").agg(F.max("_head").alias("_head"))  # repeated rows send equal heads
    joined = own.join(order.select("doc_id", "_key", F.col("next__key").alias("_next"), "_take"), "_key").join(heads, "_key")
    keep = F.substring("text", F.lit(1), (F.length("text") - F.col("_take")).cast("int"))
    return joined.select("doc_id", "text", "_key", "_next", F.concat(keep, F.col("_head")).alias("edited"))


@query("op2_document_fingerprints")
def op2_document_fingerprints(spark, sf_dir):
    """Fingerprints of every text and of its edited text, and their likeness."""
    pairs = edited_pairs(table(spark, sf_dir, "documents"))
    prints = cut(
        pairs.select(
            "doc_id", "_key", "_next", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
            fingerprint(F.col("text")).alias("_own"), fingerprint(F.col("edited")).alias("_edited"),
        )
    )
    following = prints.select(F.col("_key").alias("_next"), F.col("_own").alias("_following")).groupBy("_next").agg(F.max("_following").alias("_following"))
    both = prints.join(following, "_next")
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("_own")).alias("fingerprint"),
        F.lower(F.hex("_edited")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_edited")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_following")).alias("near_next"),
    )
