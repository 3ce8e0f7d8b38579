"""Phrase collocations by direct-address tiling.

Words get numbers by falling frequency.  A slice of the corpus counts its pairs
of neighbours tile by tile of the square of those numbers: tiles that are hit
often enough are dense and counted by ``bincount`` over their addresses, all
others as sorted coordinates.  Spark adds up the slices' counts.  Pairs that are
frequent in the whole corpus get numbers of their own, again by falling
frequency, and take their first word's place: neighbours in the new sequence are
phrases of one word more, counted in the same way, up to the greatest length.
What is not frequent becomes a gap, so a sequence shrinks from length to length;
a phrase can only be frequent if its two shorter parts are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm import word_slices as W
from tallyframe.llm.common import give_back, stored

#: What parts pieces and words.
BREAKS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
MOST_WORDS, LEAST, FIRST = 5, 100, 2000
#: Side of a tile (a power of two), tiles from the top-left corner that may be dense, and hits for each cell that make a tile dense.
TILE_BITS, CORNER, DENSE = 10, 16, 1 / 16


def _sliced(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """Slices of the corpus: a row with ``numbers`` (0 between pieces), and a row with the words of each language."""
    narrow = docs.select(F.col(text_col).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    kind = W.kinds(BLANKS, BREAKS)
    wire = pa.schema([("slice", pa.int64()), ("numbers", pa.binary()), ("lang", pa.string()), ("words", pa.binary()), ("locals", pa.binary()),
                      ("n0", pa.binary()), ("tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth, size, numbers, sequence = 0, 0, W.Numbers(), []

        def flush() -> pa.RecordBatch:
            here, counts = W.slice_number(nth), numbers.counted()[0]
            rows = [{"slice": here, "numbers": W.packed(np.concatenate(sequence))}]
            for lang, mine in numbers.by_group():
                n = counts[mine - 1]
                rows.append({"slice": here, "lang": lang, "words": W.packed_words([numbers.words[i - 1] for i in mine.tolist()]),
                             "locals": W.packed(mine), "n0": W.packed(n.astype("u4")), "tokens": int(n.sum())})
            return pa.RecordBatch.from_pylist(rows, wire)

        for chunk in W.chunks(batches, 0):
            langs = chunk.column(1).dictionary_encode()
            texts, code = chunk.column(0).cast(pa.binary()).to_pylist(), langs.indices.to_numpy()
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                words, _, parted = W.split_words([texts[j] or b"" for j in np.flatnonzero(code == i).tolist()], kind)
                found = numbers.of(lang, words)
                numbers.count(0, found)
                places = np.arange(len(found)) + np.cumsum(parted)
                line = np.zeros(int(places[-1]) + 2 if len(places) else 1, "u4")  # ends in a gap
                line[places] = found
                sequence.append(line)
            size += sum(map(len, filter(None, texts)))
            if size >= W.SLICE_BYTES:
                yield flush()
                nth, size, numbers, sequence = nth + 1, 0, W.Numbers(), []
        if sequence:
            yield flush()
        give_back()

    return narrow.mapInArrow(run, "slice long, numbers binary, lang string, words binary, locals binary, n0 binary, tokens long")


def _words_asked(sliced: DataFrame, buckets: int) -> DataFrame:
    """Blocks of the distinct words of each slice and language, with their numbers there."""
    wire = pa.schema([("slice", pa.int64()), ("lang", pa.string()), ("bucket", pa.int32()), ("keys", pa.binary()), ("locals", pa.binary()), ("n0", pa.binary())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in W.rows_of(batches):
            data = W.unpacked_words(row["words"])
            words, local, n = np.array(data.split(b"\n"), object), W.unpacked(row["locals"], "u4"), W.unpacked(row["n0"], "u4")
            hashes = np.fromiter(map(zlib.crc32, words), "u8", len(words))
            for b, at in W.bucketed(hashes, buckets):
                yield pa.RecordBatch.from_pylist([{"slice": row["slice"], "lang": row["lang"], "bucket": b, "keys": W.packed_words(words[at].tolist()),
                                                   "locals": W.packed(local[at]), "n0": W.packed(n[at])}], wire)
        give_back()

    listed = sliced.where("words is not null").select("slice", "lang", "words", "locals", "n0")
    return listed.mapInArrow(ask, "slice long, lang string, bucket int, keys binary, locals binary, n0 binary")


def _frequent_words(blocks: DataFrame, least: int) -> DataFrame:
    """``lang, bucket, slice, keys, locals, totals``: the frequent words of each slice; without a slice, all of a bucket with their counts."""
    def reply(rows, keys, places, sums):
        often = sums[0] >= least
        where = {"lang": rows[0]["lang"], "bucket": rows[0]["bucket"]}
        yield where | {"words": [w.decode() for w in keys.filter(pa.array(often)).to_pylist()], "totals": sums[0][often].tolist()}
        for row, mine in zip(rows, places):
            kept = often[mine]
            yield where | {"slice": row["slice"], "keys": W.packed_words(keys.take(pa.array(mine[kept])).to_pylist()),
                           "locals": W.packed(W.unpacked(row["locals"], "u4")[kept])}
    return W.added_up(blocks, ["n0"], reply, "lang string, bucket int, slice long, keys binary, locals binary, words array<string>, totals array<long>",
                      words=True, by=("lang", "bucket"))


_IDS = "slice long, keys binary, ids binary"
_IDS_WIRE = pa.schema([("slice", pa.int64()), ("keys", pa.binary()), ("ids", pa.binary())])


def _word_ids(blocks: DataFrame, numbered: DataFrame) -> DataFrame:
    """``slice, keys, ids``: numbers that the slice's frequent words have there and in the corpus."""
    def tell(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = dict(zip((w.encode() for w in right.column("word").to_pylist()), right.column("id").to_pylist()))
        rows = []
        for row in left.to_pylist():
            local = W.unpacked(row["locals"], "u4")
            words = W.unpacked_words(row["keys"]).split(b"\n") if len(local) else []
            rows.append({"slice": row["slice"], "keys": W.packed(local.astype("u8")), "ids": W.packed(np.array([ids[w] for w in words], "u4"))})
        return pa.Table.from_pylist(rows, _IDS_WIRE)

    here = blocks.where("slice is not null").select("lang", "bucket", "slice", "keys", "locals")
    return here.groupBy("lang", "bucket").cogroup(numbered.select("lang", "bucket", "word", "id").groupBy("lang", "bucket")).applyInArrow(tell, _IDS)


def _pair_ids(blocks: DataFrame, numbered: DataFrame) -> DataFrame:
    """``slice, keys, ids``: numbers of the slice's frequent pairs."""
    def tell(left: pa.Table, right: pa.Table) -> pa.Table:
        known, ids = right.column("key").to_numpy().astype("u8"), right.column("id").to_numpy().astype("u4")
        order = np.argsort(known)
        known, ids = known[order], ids[order]
        rows = []
        for row in left.to_pylist():
            keys = W.unpacked_sorted(row["keys"])
            rows.append({"slice": row["slice"], "keys": W.packed(keys), "ids": W.packed(ids[np.searchsorted(known, keys)])})
        return pa.Table.from_pylist(rows, _IDS_WIRE)

    here = blocks.where("slice is not null").select("bucket", "slice", "keys")
    return here.groupBy("bucket").cogroup(numbered.select("bucket", "key", "id").groupBy("bucket")).applyInArrow(tell, _IDS)


def _pairs(line: np.ndarray) -> np.ndarray:
    """Key of every two neighbours that are no gaps, in order of place."""
    a, b = line[:-1], line[1:]
    both = (a > 0) & (b > 0)
    return a[both].astype("u8") << np.uint64(32) | b[both]


def count_pairs(line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of neighbours, ascending, and how often they occur: dense tiles and sorted coordinates."""
    keys = _pairs(line)
    a, b = (keys >> np.uint64(32)).astype("i8") - 1, (keys & np.uint64(0xFFFFFFFF)).astype("i8") - 1
    side = 1 << TILE_BITS
    corner = (a < side * CORNER) & (b < side * CORNER)
    tile = np.where(corner, (a >> TILE_BITS) * CORNER + (b >> TILE_BITS), CORNER * CORNER)
    hits = np.bincount(tile, minlength=CORNER * CORNER + 1)[:-1]
    dense = np.append(hits >= side * side * DENSE, False)
    found, counts = [], []
    for t in np.flatnonzero(dense).tolist():
        here = tile == t
        cells = np.bincount((a[here] & side - 1) << TILE_BITS | b[here] & side - 1, minlength=side * side)
        at = np.flatnonzero(cells)
        first, second = (t // CORNER << TILE_BITS) + (at >> TILE_BITS) + 1, (t % CORNER << TILE_BITS) + (at & side - 1) + 1
        found.append(first.astype("u8") << np.uint64(32) | second.astype("u8"))
        counts.append(cells[at])
    rest = np.sort(keys[~dense[tile]])
    head = np.flatnonzero(np.diff(rest, prepend=rest[:1] - np.uint64(1)))
    found.append(rest[head])
    counts.append(np.diff(head, append=len(rest)))
    every, n = np.concatenate(found), np.concatenate(counts)
    order = np.argsort(every)
    return every[order], n[order].astype("u4")


def squeezed(line: np.ndarray) -> np.ndarray:
    """The same sequence without gaps beside gaps and without single items between gaps."""
    full = line > 0
    beside = np.concatenate(([False], full[:-1])) | np.concatenate((full[1:], [False]))
    line = np.where(beside, line, 0) if len(line) else line
    full = line > 0
    return line[full | np.concatenate(([True], full[:-1]))] if len(line) else line


def _renumbered(line: np.ndarray, keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The sequence of the frequent pairs' numbers, at the place of their first items."""
    out = np.zeros(max(0, len(line) - 1) + 1, "u4")
    if len(keys) and len(line) > 1:
        a, b = line[:-1], line[1:]
        both = np.flatnonzero((a > 0) & (b > 0))
        pair = a[both].astype("u8") << np.uint64(32) | b[both]
        at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
        out[both] = np.where(keys[at] == pair, ids[at], 0)
    return out


_STEP = "slice long, numbers binary, bucket int, keys binary, n0 binary"
_STEP_WIRE = pa.schema([("slice", pa.int64()), ("numbers", pa.binary()), ("bucket", pa.int32()), ("keys", pa.binary()), ("n0", pa.binary())])


def _counted(lines: DataFrame, ids: DataFrame, buckets: int, words: bool) -> DataFrame:
    """Next sequence of every slice, and the counts of its pairs in blocks.

    ``ids``: ``slice, keys, ids``; a key is a slice's number of a word (``words``) or a pair.
    """
    def step(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, told = [], right.to_pylist()
        keys = np.concatenate([W.unpacked(r["keys"], "u8") for r in told] or [np.empty(0, "u8")])
        new = np.concatenate([W.unpacked(r["ids"], "u4") for r in told] or [np.empty(0, "u4")])
        for row in left.to_pylist():
            line = W.unpacked(row["numbers"], "u4")
            if words:
                table = np.zeros(max(int(line.max(initial=0)), int(keys.max(initial=0))) + 1, "u4")
                table[keys.astype("i8")] = new
                line = squeezed(table[line])
            else:
                order = np.argsort(keys)
                line = squeezed(_renumbered(line, keys[order], new[order]))
            rows.append({"slice": row["slice"], "numbers": W.packed(line)})
            pairs, n = count_pairs(line)
            rows += [{"slice": row["slice"], "bucket": b, "keys": W.packed_sorted(pairs[at]), "n0": W.packed(n[at])} for b, at in W.bucketed(pairs, buckets)]
        give_back()
        return pa.Table.from_pylist(rows, _STEP_WIRE)

    return lines.groupBy("slice").cogroup(ids.groupBy("slice")).applyInArrow(step, _STEP)


def _frequent_pairs(blocks: DataFrame, least: int) -> DataFrame:
    """``bucket, slice, keys, pairs, totals``: the frequent pairs of each slice; without a slice, all of a bucket with their counts."""
    def reply(rows, keys, places, sums):
        often = sums[0] >= least
        yield {"bucket": rows[0]["bucket"], "pairs": keys[often].astype("i8").tolist(), "totals": sums[0][often].tolist()}
        for row, mine in zip(rows, places):
            yield {"bucket": row["bucket"], "slice": row["slice"], "keys": W.packed_sorted(keys[mine[often[mine]]])}
    return W.added_up(blocks, ["n0"], reply, "bucket int, slice long, keys binary, pairs array<long>, totals array<long>")


class TooManyPhrases(ValueError):
    """More frequent phrases of one length than 32 bits number."""


def _check(n: int, length: int) -> None:
    if n >= 1 << 32:
        raise TooManyPhrases(f"{n} phrases of {length} words")


def frequent_phrases(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, text_col: str = "text", lang_col: str = "lang") -> tuple[list[DataFrame], DataFrame]:
    """Every phrase of up to ``most_words`` words with at least ``least`` occurrences, by length; and ``lang, total`` words.

    A table a length: ``id, lang, words, n, heads, tails`` and, from two words on, ``left, right``: ids of
    the phrase without its last and without its first word.  ``heads[k - 1]`` and ``tails[k - 1]`` are the
    counts of its first and last ``k`` words.
    """
    sliced = stored(_sliced(docs, text_col, lang_col), "phrase-slices", "zstd")
    totals = stored(sliced.where("words is not null").groupBy("lang").agg(F.sum("tokens").alias("total")), "phrase-totals")
    buckets = max(1, -(-(totals.agg(F.sum("total")).first()[0] or 0) // W.BUCKET_WORDS))

    known = stored(_frequent_words(_words_asked(sliced, buckets), least), "phrase-words")
    found = known.where("slice is null").select("lang", "bucket", F.explode(F.arrays_zip("words", "totals")).alias("w")).select(
        "lang", "bucket", F.col("w.words").alias("word"), F.col("w.totals").alias("n"))
    numbered, n = W.ranked(found, "phrase-1", F.desc("n"), "lang", "word")
    _check(n, 1)
    ids = _word_ids(known, numbered)
    lengths = [numbered.select("id", "lang", F.array("word").alias("words"), "n", F.array("n").alias("heads"), F.array("n").alias("tails"))]

    lines = sliced.where("numbers is not null").select("slice", "numbers")
    for length in range(2, most_words + 1):
        step = stored(_counted(lines, ids, buckets, words=length == 2), f"phrase-{length}-counts", "zstd")
        pairs = stored(_frequent_pairs(step.where("keys is not null").select("bucket", "slice", "keys", "n0"), least), f"phrase-{length}-pairs")
        found = pairs.where("slice is null").select("bucket", F.explode(F.arrays_zip("pairs", "totals")).alias("p")).select(
            "bucket", F.col("p.pairs").alias("key"), F.col("p.totals").alias("n"))
        numbered, n = W.ranked(found, f"phrase-{length}-sort", F.desc("n"), "key")
        _check(n, length)
        parts = numbered.select("id", "n", F.shiftright("key", 32).alias("left"), F.col("key").bitwiseAND(0xFFFFFFFF).alias("right"))
        before = lengths[-1]
        head = before.select(F.col("id").alias("left"), "lang", F.col("words").alias("first_words"), F.col("heads").alias("first_heads"))
        tail = before.select(F.col("id").alias("right"), F.element_at("words", -1).alias("last_word"), F.col("tails").alias("last_tails"))
        joined = parts.join(head, "left").join(tail, "right")
        lengths.append(stored(joined.select(
            "id", "lang", F.array_append("first_words", F.col("last_word")).alias("words"), "n", F.array_append("first_heads", F.col("n")).alias("heads"),
            F.array_append("last_tails", F.col("n")).alias("tails"), "left", "right"), f"phrase-{length}"))
        lines = step.where("numbers is not null").select("slice", "numbers")
        ids = _pair_ids(pairs, numbered)
    return lengths, totals


def _not_inside(phrases: DataFrame, longer: DataFrame | None) -> DataFrame:
    """Phrases that stand in no longer one of the same count.

    Looking one word further is enough: every phrase between the two has that
    count as well.
    """
    if longer is None:
        return phrases
    around = longer.select(F.explode(F.array("left", "right")).alias("id"), "n").groupBy("id").agg(F.max("n").alias("around"))
    kept = phrases.join(around, "id", "left")
    return kept.where(F.coalesce(F.col("around") < F.col("n"), F.lit(True))).drop("around")


def lowest_cut(heads: Column, tails: Column, n: Column, total: Column) -> Column:
    """Score, l and r of the cut with the lowest ``floor(1000 n total / (l r))``, the first of equal ones; exact up to 38 digits."""
    def wide(c: Column) -> Column:
        return c.cast("decimal(19,0)")

    size = F.size(heads)
    joint = (wide(n) * F.lit(1000).cast("decimal(4,0)")).cast("decimal(22,0)")

    def cut(k: Column) -> Column:
        left, right = F.get(heads, k - 1), F.get(tails, size - k - 1)
        score = F.call_function("div", (joint * wide(total)).cast("decimal(38,0)"), (wide(left) * wide(right)).cast("decimal(38,0)"))
        return F.struct(score.alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))
    return F.array_min(F.transform(F.sequence(F.lit(1), size - 1), cut))


def collocations(docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, first: int = FIRST,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``first`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A null text is empty, a null language is ``und`` (as a language of that name
    is).  Repeated rows count as often as they stand there.  A language without
    a frequent phrase, or an empty table, gives no rows.  Other columns are not read.
    A phrase inside a longer one (of up to ``most_words`` words) of the same count is left out.
    """
    lengths, totals = frequent_phrases(docs, least, most_words, text_col, lang_col)
    kept = None
    for phrases, longer in zip(lengths[1:], [*lengths[2:], None]):
        some = _not_inside(phrases, longer).select("lang", "words", "n", "heads", "tails")
        kept = some if kept is None else kept.unionByName(some)
    cut = lowest_cut(F.col("heads"), F.col("tails"), F.col("n"), F.col("total"))
    scored = kept.join(totals, "lang").withColumn("cut", cut).select(
        "lang", F.array_join("words", " ").alias("phrase"), F.col("n").alias("a"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
        F.col("total").alias("n"), F.col("cut.score").alias("score"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= first).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
