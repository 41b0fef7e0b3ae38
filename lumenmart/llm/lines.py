"""Removal of lines that repeat an earlier line up to one changed word, in SQL expressions only.

Lines are compared as sequences of lower-cased words. The edit bound is one
word put in, left out or replaced. Two lines within it have a variant in common
when each may leave out one word: the lines that leave out the word at the same
place differ in that word only, and a line that is the variant itself lacks it.
So every line emits its variants as hashed keys, equal keys meet, and per key
and place the earliest line stands for all others: the rule asks for any
earlier line within the bound, and if a group holds one, its earliest line is
one. A group of any size gives one link per line, never pairs. The link is then
verified on the words.

Equal lines are brought down to one row first. Of the rest, long lines take
part only if another line shares one of their halves, since one edit leaves a
half unchanged: each line hashes its halves as cut for its own length and for
a length one less, and half keys that occur once drop out.

Hashes of variants are polynomials of the words' hashes, so all variants of a
line come from one array of running sums. Before rows are joined with a small
part of them, the keys of that part are put into a bitmap of fixed size, which
is broadcast (``BITS`` / 8 bytes), so that the other rows stay where they are.
The texts are shuffled once, when the lines to drop meet their documents.

One word is much of a short line, so lines under ``MIN_WORDS`` words are left
alone, or with ``short`` go where their words equal those of an earlier line.
Lines without words always stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenmart.llm.common import WORD_GAP, fresh_names, saved

#: Words of the shortest line that is compared with changes, and of the shortest whose halves are looked at first.
MIN_WORDS, HALVED = 5, 10
#: Bits of a bitmap: 4 MB. With far more keys than bits all rows pass, and the joins do the work alone.
BITS = 1 << 25
#: Words whose sums are made together; primes and bases of the polynomial hashes.
SUMS = 128
PRIMES, BASES = (2147483647, 2147483629), (1000003, 998244353 % 2147483629)


def _bitmap(keys: DataFrame, key: Column) -> DataFrame:
    """At most ``BITS`` / 32768 rows of 4 KB: the bits that the keys' hashes set."""
    place = F.pmod(F.xxhash64(key), F.lit(BITS)) + 1
    bits = keys.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("_bucket"))
    return bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("_bits"))


def _maybe_in(rows: DataFrame, key: Column, bitmap: DataFrame) -> DataFrame:
    """Rows whose key may be one of the bitmap's; none that is gets lost."""
    place = F.pmod(F.xxhash64(key), F.lit(BITS)) + 1
    rows = rows.withColumns({"_bucket": F.bitmap_bucket_number(place), "_bit": F.bitmap_bit_position(place)})
    hit = F.expr("shiftright(cast(conv(hex(substring(_bits, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int), cast(_bit % 8 as int)) & 1") == 1
    return rows.join(F.broadcast(bitmap), "_bucket").where(hit).drop("_bucket", "_bit", "_bits")


def _words(line: Column) -> Column:
    """Lower-cased words of a line. Most lines have single spaces between them, and splitting there takes no pattern."""
    gaps = reduce(Column.__or__, [F.contains(line, F.lit(c)) for c in ("  ", "\t", "\x0b", "\x0c", "\r")])
    uneven = gaps | F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))
    trimmed = F.split(F.btrim(F.lower(line), F.lit(" \t\n\x0b\x0c\r")), WORD_GAP)
    return F.when(uneven, trimmed).otherwise(F.split(F.lower(line), " "))


def _documents(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def _halves() -> list[Column]:
    """Keys of the first and last words, cut for ``n`` words and for one less; one of the four cuts always repeats."""
    first = lambda k: F.xxhash64(F.lit(1), F.slice("words", 1, k.cast("int")))
    last = lambda k: F.xxhash64(F.lit(2), F.slice("words", F.col("n") - k.cast("int") + 1, k.cast("int")))
    n, odd = F.col("n"), F.col("n") % 2 == 1
    down, up = F.floor(n / 2), F.ceil(n / 2)
    # lines just too short to need a shared half still show theirs to longer ones
    halved = lambda key: F.when(n >= HALVED - 1, key)
    return [halved(first(down)), halved(last(up)), halved(F.when(odd, last(down)).otherwise(first(down - 1)))]


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """``doc_id``, ``pos``, ``n``, the line's hashes ``h1`` and ``h2``, and its half keys ``k0`` to ``k2``."""
    each = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    # a generator's rows are filtered after it; a filter on a projection would be pushed below it and split every line again
    each = each.select("doc_id", "pos", F.explode(F.array(_words(F.col("line")))).alias("words"))
    each = each.withColumn("n", F.size("words")).where((F.col("n") >= min_words) & (F.element_at("words", 1) != ""))
    return each.select("doc_id", "pos", "n", F.xxhash64("words").alias("h1"), F.hash("words").alias("h2"), *(k.alias(f"k{i}") for i, k in enumerate(_halves())))


def _running_sums(prime: int, base: int) -> Column:
    """Sums of the words' hashes times powers of the base, modulo the prime; the first is 0.

    In a line of more than ``SUMS`` words they are made per block of so many and
    then moved to the block's place in the line, so that no array longer than a
    block, or than the number of blocks, is ever copied to append to it.
    """
    none = F.struct(F.array(F.lit(0).cast("bigint")).alias("sums"), F.lit(1).cast("bigint").alias("power"))

    def add(state: Column, h: Column) -> Column:
        following = (F.element_at(state["sums"], -1) + F.pmod(h, F.lit(prime)) * state["power"]) % prime
        return F.struct(F.array_append(state["sums"], following).alias("sums"), (state["power"] * base % prime).alias("power"))

    summed = lambda hashes: F.aggregate(hashes, none, add, lambda state: state["sums"])
    block = lambda b: summed(F.slice("hashes", b * SUMS + 1, F.lit(SUMS)))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("hashes") - 1) / SUMS).cast("int")), block)

    here = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(1).cast("bigint").alias("power"))
    step = pow(base, SUMS, prime)

    def move(places: Column, sums: Column) -> Column:
        last = F.element_at(places, -1)
        following = (last["sum"] + F.element_at(sums, -1) * last["power"]) % prime
        return F.array_append(places, F.struct(following.alias("sum"), (last["power"] * step % prime).alias("power")))

    places = F.aggregate(blocks, F.array(here), move)
    moved = F.zip_with(
        blocks, F.slice(places, 1, F.size(places) - 1),
        lambda sums, at: F.transform(F.slice(sums, 1, F.size(sums) - 1), lambda x: (at["sum"] + x * at["power"]) % prime),
    )
    long = F.concat(F.flatten(moved), F.array(F.element_at(places, -1)["sum"]))
    return F.when(F.size("hashes") <= SUMS, summed(F.col("hashes"))).otherwise(long)


def _without(sums: Column, place: Column, prime: int, base: int) -> Column:
    """Hash of the line without the word at ``place``, or of the whole line for 0: what follows moves down one power."""
    rest = (F.element_at(sums, -1) - F.get(sums, place) + prime) % prime
    left_out = (F.get(sums, F.greatest(place - 1, F.lit(0))) + rest * pow(base, -1, prime)) % prime
    return F.when(place == 0, F.element_at(sums, -1)).otherwise(left_out)


def _variants(lines: DataFrame) -> DataFrame:
    """``first``, ``place`` (0: nothing left out) and ``key`` of the line without the word there."""
    hashes = list(zip(("_s0", "_s1"), PRIMES, BASES, strict=True))
    lines = lines.withColumns({name: _running_sums(prime, base) for name, prime, base in hashes})

    def variant(place: Column) -> Column:
        high, low = (_without(F.col(name), place, prime, base) for name, prime, base in hashes)
        return F.struct(place.alias("place"), F.shiftleft(high, 31).bitwiseOR(low).alias("key"))

    each = F.transform(F.sequence(F.lit(0), F.size("words")), variant)
    return lines.select("first", F.explode(each).alias("v")).select("first", "v.*")


def _within_one_word(x: Column, y: Column) -> Column:
    """Equal words at both ends leave at most one word of the longer line."""
    longer = F.greatest(F.size(x), F.size(y))
    lead = lambda a, b: F.coalesce(F.nullif(F.array_position(F.zip_with(a, b, lambda p, q: p.eqNullSafe(q)), False), F.lit(0)) - 1, longer)
    return lead(x, y) + lead(F.reverse(x), F.reverse(y)) >= longer - 1


def _candidates(distinct: DataFrame) -> DataFrame:
    """``doc_id`` and ``pos`` of the different lines that may have one within an edit."""
    keys = distinct.where(F.col("n") >= HALVED - 1).select(F.explode(F.array("k0", "k1", "k2")).alias("key"), "n", "doc_id", "pos")
    shared = saved(keys.groupBy("key").agg(F.count("*").alias("times")).where("times > 1").select("key"), "shared-halves")
    near = _maybe_in(keys.where(F.col("n") >= HALVED), F.col("key"), _bitmap(shared, F.col("key"))).join(shared, "key", "leftsemi")
    return near.select("doc_id", "pos").unionByName(distinct.where(F.col("n") < HALVED).select("doc_id", "pos")).distinct()


def _earlier_lines(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """``h1``, ``h2`` of the lines that have an earlier, different line within one word."""
    wanted = saved(_candidates(distinct).withColumnsRenamed({"doc_id": "_id", "pos": "_pos"}), "line-candidates")
    each = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    each = _maybe_in(each, F.struct("doc_id", "pos"), _bitmap(wanted, F.struct("_id", "_pos")))
    found = each.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("pos") == F.col("_pos")))
    # rows of one id may hold different lines at one place
    found = found.select(F.struct("doc_id", "pos").alias("first"), _words(F.col("line")).alias("words"))
    each_hash = F.transform("words", lambda w: F.xxhash64(w))
    lines = saved(found.withColumns({"h1": F.xxhash64("words"), "h2": F.hash("words"), "hashes": each_hash}).dropDuplicates(["h1", "h2"]), "line-words")

    variants = saved(_variants(lines), "line-variants")
    heads = variants.groupBy("key", "place").agg(F.min("first").alias("head"), F.count("*").alias("lines"))
    places = F.struct(F.col("place"), F.col("head"))
    by_key = heads.groupBy("key").agg(
        F.min(F.when(F.col("place") == 0, F.col("head"))).alias("whole"),
        F.min(F.when(F.col("place") > 0, F.col("head"))).alias("shortened"),
        F.collect_set(places).alias("places"),  # one per place of a line
        F.sum("lines").alias("all"),
    )
    partner = F.when(F.col("p.place") == 0, F.col("shortened")).otherwise(F.least("p.head", "whole"))
    by_key = by_key.where("all > 1").select("key", "whole", "shortened", F.explode("places").alias("p"))
    heads = saved(by_key.select("key", F.col("p.place").alias("place"), partner.alias("earlier")).where("earlier is not null"), "line-heads")
    met = _maybe_in(variants, F.struct("key", "place"), _bitmap(heads, F.struct("key", "place"))).join(heads, ["key", "place"])
    links = met.where("earlier < first").select("first", "earlier").distinct()
    other = lines.select(F.col("first").alias("earlier"), F.col("words").alias("theirs"))
    verified = links.join(other, "earlier").join(lines.select("first", "words", "h1", "h2"), "first")
    return verified.where(_within_one_word(F.col("words"), F.col("theirs"))).select("h1", "h2").distinct()


def repeated_lines(df: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text", short: bool = False) -> DataFrame:
    """``doc_id`` and ``positions`` (from 0) of the lines that repeat an earlier one.

    Earlier is by ``doc_id``, then place in the document; a null id comes first.
    Lines of fewer than ``min_words`` words never count, or with ``short`` count
    by equality. Rows that share an id are one document: their lines at one place
    are equally early.
    """
    docs = _documents(df, doc_id, text)
    lines = saved(_lines(docs, 1 if short else min_words), "lines")
    distinct = lines.groupBy("h1", "h2", "n", "k0", "k1", "k2").agg(F.min(F.struct("doc_id", "pos")).alias("first"), F.count("*").alias("times"))
    distinct = saved(distinct.select("h1", "h2", "n", "first.doc_id", "first.pos", "times", "k0", "k1", "k2"), "different-lines")
    near = _earlier_lines(docs, distinct.where(F.col("n") >= min_words)).withColumn("near", F.lit(True))
    repeated = distinct.select("h1", "h2", F.struct("doc_id", "pos").alias("first"), "times").join(near, ["h1", "h2"], "left")
    repeated = repeated.where("times > 1 or near").select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near"))
    repeated = saved(repeated, "repeated-lines")
    places = _maybe_in(lines.select("doc_id", "pos", "h1", "h2"), F.col("h1"), _bitmap(repeated, F.col("h1"))).join(repeated, ["h1", "h2"])
    dropped = places.where(F.col("near") | (F.struct("doc_id", "pos") > F.col("first")))
    return dropped.groupBy("doc_id").agg(F.array_sort(F.collect_set("pos")).alias("positions"))


def without_repeated_lines(df: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text", short: bool = False) -> DataFrame:
    """All rows and columns, with the repeated lines taken out of the text, and ``n_lines`` and ``n_dropped``.

    A null text stays null. Empty texts, empty tables and very long lines need
    no rule of their own: the work grows with the words of a line. Columns named
    ``n_lines`` or ``n_dropped`` are replaced, all others stay.
    """
    key, gone, each, kept = fresh_names(df, "_id", "_gone", "_lines", "_kept")
    found = repeated_lines(df, min_words, doc_id, text, short).withColumnsRenamed({"doc_id": key, "positions": gone})
    rows = df.join(found, F.col(doc_id).eqNullSafe(F.col(key)), "left").withColumn(each, F.split(F.col(text), "\n"))
    # rows of one id may be of different length; places beyond the end are no lines
    all_ = F.sequence(F.lit(0), F.size(each) - 1)
    rows = rows.withColumn(kept, F.when(F.col(gone).isNotNull(), F.array_except(all_, F.col(gone))).otherwise(all_))
    n_lines = F.coalesce(F.size(each), F.lit(0)).cast("bigint")
    rows = rows.withColumns(
        {
            "n_lines": F.greatest(n_lines, F.lit(0)),
            "n_dropped": F.greatest(n_lines - F.coalesce(F.size(kept), F.lit(0)), F.lit(0)).cast("bigint"),
            text: F.when(F.col(gone).isNull() | F.col(text).isNull(), F.col(text)).otherwise(F.array_join(F.transform(kept, lambda i: F.get(each, i)), "\n")),
        }
    )
    return rows.drop(key, gone, each, kept)
