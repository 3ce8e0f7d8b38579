"""Language-model scores by deleted interpolation.

A bigram model: the maximum-likelihood estimates of a token after the one before
it, of the token alone, and an equal share for every known token and one more are
mixed with weights that depend on how often the context (the token before) was
seen, in buckets of powers of two.  The weights are those that fit counts left
out of the estimates best: training documents are parted in two, estimates come
from the first part, and expectation-maximisation fits each bucket's weights to
the tokens of the second.  The scores then use the counts of both.

Counts cover the whole corpus.  Each slice asks once for the counts of its
distinct words (by their letters) and of its distinct pairs (by 64-bit hashes), in blocks,
never for single occurrences, and gets them back in the order it asked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm import word_slices as W
from tallyframe.llm.common import give_back, stored
from tallyframe.llm.shingles import mixed, word_hashes

#: Parts of the documents: estimates, weights of the mixture, and only scored.
ESTIMATES, WEIGHTS, HELD_OUT = 0, 1, 2
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Buckets of contexts (unseen, then each power of two) and the most rounds of expectation-maximisation; it ends earlier when no weight moves by ``STILL``.
BUCKETS, ROUNDS, STILL = 65, 20, 1e-3
#: Places of a slice that are looked up together.
STRETCH = 1 << 19
_END_HASH, _FIRST, _SECOND = np.uint64(0x51A4E0F5C7D2B391), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


@dataclass
class Model:
    """Tokens, distinct tokens and ends of training, and a bucket's weights of pair, token and equal share."""

    tokens: int
    distinct: int
    ends: int
    weights: np.ndarray


def _wire(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def _sliced(docs: DataFrame, part: Column, id_col: str, text_col: str) -> DataFrame:
    """Slices of the corpus, a row each: numbered tokens (0 for an end), words, and how often they occur in the two parts."""
    narrow = docs.select(F.col(text_col).alias("text"), F.coalesce(part, F.lit(ESTIMATES)).cast("int").alias("part"), F.col(id_col).alias("id"))
    id_type = narrow.schema["id"].dataType.simpleString()
    schema = f"slice long, numbers binary, words binary, n0 binary, n1 binary, lengths binary, parts binary, ids array<{id_type}>, docs0 long, docs1 long, tokens long"
    wire, kind = _wire(schema), W.kinds(BLANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth, size = 0, 0
        numbers, lines, lengths, parts, ids = W.Numbers(2), [], [], [], []

        def flush() -> pa.RecordBatch:
            part, line, counts = np.concatenate(parts).astype("u1"), np.concatenate(lines), numbers.counted()
            return pa.RecordBatch.from_pylist([{
                "slice": W.slice_number(nth), "numbers": W.packed(line), "words": W.packed_words(numbers.words), "n0": W.packed(counts[0].astype("u4")),
                "n1": W.packed(counts[1].astype("u4")), "lengths": W.packed(np.concatenate(lengths)), "parts": part.tobytes(), "ids": [i for some in ids for i in some.to_pylist()],
                "docs0": int((part == ESTIMATES).sum()), "docs1": int((part == WEIGHTS).sum()), "tokens": len(line)}], wire)

        for chunk in W.chunks(batches, 0):
            texts = [t or b"" for t in chunk.column(0).cast(pa.binary()).to_pylist()]
            words, first, _ = W.split_words(texts, kind)
            found, part = numbers.of("", words), chunk.column(1).to_numpy()
            which = np.repeat(part, np.diff(first))
            for p in (ESTIMATES, WEIGHTS):
                numbers.count(p, found[which == p])
            lines.append(np.insert(found, first[1:], np.uint32(0)))
            lengths.append((np.diff(first) + 1).astype("u4"))
            parts.append(part)
            ids.append(chunk.column(2))
            size += sum(map(len, texts))
            if size >= W.SLICE_BYTES:
                yield flush()
                nth, size = nth + 1, 0
                numbers, lines, lengths, parts, ids = W.Numbers(2), [], [], [], []
        if lines:
            yield flush()
        give_back()

    return narrow.mapInArrow(run, schema)


def _hashes(words: bytes) -> np.ndarray:
    """Hash of each of a slice's words; none of them holds ASCII white space."""
    return word_hashes(words)[0]


def _places(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token and context at every place, documents' first places, and the part of every place."""
    line, lengths = W.unpacked(row["numbers"], "u4"), W.unpacked(row["lengths"], "u4").astype("i8")
    starts = np.cumsum(lengths) - lengths
    before = np.roll(line, 1)
    before[starts] = 0  # every document begins after an end
    return line, before, starts, np.repeat(np.frombuffer(row["parts"], "u1"), lengths)


def _keys(hashes: np.ndarray, before: np.ndarray, line: np.ndarray) -> np.ndarray:
    return mixed((hashes * _FIRST)[before] + (hashes * _SECOND)[line])


def _pair_hashes(row: dict) -> np.ndarray:
    return np.concatenate(([_END_HASH], _hashes(W.unpacked_words(row["words"]))))


_BLOCK = "slice long, bucket int, keys binary, n0 binary, n1 binary"


def _words_asked(sliced: DataFrame, buckets: int) -> DataFrame:
    """Blocks of the distinct words of each slice with their counts in the two parts."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in W.rows_of(batches):
            data = W.unpacked_words(row["words"])
            words, counts = np.array(data.split(b"\n"), object), [W.unpacked(row[f"n{i}"], "u4") for i in range(2)]
            for b, at in W.bucketed(_hashes(data), buckets, hashed=True):
                yield pa.RecordBatch.from_pylist([{"slice": row["slice"], "bucket": b, "keys": W.packed_words(words[at].tolist()),
                                                   "n0": W.packed(counts[0][at]), "n1": W.packed(counts[1][at])}], wire)
        give_back()

    wire = _wire(_BLOCK)
    return sliced.select("slice", "words", "n0", "n1").mapInArrow(ask, _BLOCK)


def _pairs_asked(sliced: DataFrame, buckets: int) -> DataFrame:
    """Blocks of the distinct pairs of each slice with their counts in the two parts (none if only held out)."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in W.rows_of(batches):
            line, before, _, part = _places(row)
            keys = _keys(_pair_hashes(row), before, line)
            del line, before
            order = np.argsort(keys)
            keys, part = keys[order], part[order]
            del order
            head = np.flatnonzero(np.diff(keys, prepend=keys[:1] - np.uint64(1)))
            counts = [np.add.reduceat(part == p, head, dtype="u4") for p in (ESTIMATES, WEIGHTS)]
            keys = keys[head]
            for b, at in W.bucketed(keys, buckets, hashed=True):
                yield pa.RecordBatch.from_pylist([{"slice": row["slice"], "bucket": b, "keys": W.packed_sorted(keys[at]),
                                                   "n0": W.packed(counts[0][at]), "n1": W.packed(counts[1][at])}], wire)
        give_back()

    wire = _wire(_BLOCK)
    return sliced.select("slice", "numbers", "words", "lengths", "parts").mapInArrow(ask, _BLOCK)


def _answered(blocks: DataFrame, words: bool) -> DataFrame:
    """``slice, bucket, words, c0, c1``: the whole corpus's counts of a block's keys, in the block's order.

    A row without a slice tells how many of the bucket's keys have a count in the
    first part (``distinct0``) and in any (``distinct``).
    """
    def reply(rows, keys, places, sums):
        yield {"words": words, "distinct0": int((sums[0] > 0).sum()), "distinct": int((sums[0] + sums[1] > 0).sum()), "tokens0": int(sums[0].sum()), "tokens1": int(sums[1].sum())}
        for row, mine in zip(rows, places):
            yield {"slice": row["slice"], "bucket": row["bucket"], "words": words, "c0": W.packed(sums[0][mine].astype("u8")), "c1": W.packed(sums[1][mine].astype("u8"))}
    return W.added_up(blocks, ["n0", "n1"], reply, "slice long, bucket int, words boolean, c0 binary, c1 binary, distinct0 long, distinct long, tokens0 long, tokens1 long", words)


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(context.astype("f8"))[1], BUCKETS - 1)


def _counted(sliced: DataFrame, answers: DataFrame, buckets: int, ends: tuple[int, int]) -> DataFrame:
    """Counts at every place of each slice, and the events of the part that fits the weights, a stretch of places after the other."""
    ids_type = sliced.schema["ids"].dataType.simpleString()
    listed = ", ".join(f"{name} array<binary>" for name in ("own", "pair", "event_context", "event_own", "event_pair", "event_n"))
    schema = f"slice long, ids {ids_type}, parts binary, lengths binary, {listed}"
    wire = _wire(schema)

    def place(left: pa.Table, right: pa.Table) -> pa.Table:
        by_bucket = {(r["words"], r["bucket"]): r for r in right.to_pylist()}

        def told(keys: np.ndarray, words: bool) -> np.ndarray:
            out = np.zeros((2, len(keys)), "i8")
            for b, at in W.bucketed(keys, buckets, hashed=True):
                answer = by_bucket.pop((words, b))
                out[0, at], out[1, at] = W.unpacked(answer["c0"], "u8"), W.unpacked(answer["c1"], "u8")
            return out

        row = left.to_pylist()[0]  # a slice is one row
        line, before, _, part = _places(row)
        hashes = _pair_hashes(row)
        single = np.concatenate((np.array(ends, "i8")[:, None], told(hashes[1:], True)), axis=1)
        distinct = _keys(hashes, before, line)
        distinct.sort()
        distinct = distinct[np.flatnonzero(np.diff(distinct, prepend=distinct[:1] - np.uint64(1)))]
        double = told(distinct, False)
        out = {"slice": row["slice"], "ids": row["ids"], "parts": row["parts"], "lengths": row["lengths"],
               **{k: [] for k in ("own", "pair", "event_context", "event_own", "event_pair", "event_n")}}
        for lo in range(0, len(line), STRETCH):
            here, was, fit = line[lo:lo + STRETCH], before[lo:lo + STRETCH], part[lo:lo + STRETCH] == WEIGHTS
            where = np.searchsorted(distinct, _keys(hashes, was, here))
            out["own"].append(W.packed(single.sum(axis=0)[here].astype("u8")))
            out["pair"].append(W.packed((double[0][where] + double[1][where]).astype("u8")))
            events = np.stack((single[0][was[fit]], single[0][here[fit]], double[0][where[fit]]))
            events = events[:, np.lexsort(events)]
            head = np.flatnonzero((np.diff(events, prepend=events[:, :1] - 1) != 0).any(axis=0))
            for name, values in zip(("context", "own", "pair"), events[:, head].astype("u8")):
                out[f"event_{name}"].append(W.packed(values))
            out["event_n"].append(W.packed(np.diff(head, append=events.shape[1]).astype("u4")))
        give_back()
        return pa.Table.from_pylist([out], wire)

    heads = sliced.select("slice", "numbers", "words", "lengths", "parts", "ids")
    return heads.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(place, schema)


def _estimates(context: np.ndarray, own: np.ndarray, pair: np.ndarray, tokens: int, distinct: int) -> np.ndarray:
    """Probabilities of pair, token and equal share at every place."""
    return np.stack((pair / np.maximum(context, 1), own / max(tokens, 1), np.full(len(own), 1 / (distinct + 1))))


def _fitted(counted: DataFrame, tokens: int, distinct: int) -> np.ndarray:
    """Weights of every bucket by expectation-maximisation over the stored events, a pass a round."""
    events = counted.select("event_context", "event_own", "event_pair", "event_n")
    weights = np.full((3, BUCKETS), 1 / 3)
    weights[:, 0] = 0, .5, .5  # an unseen context has no pairs

    def expected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, BUCKETS))
        for row in W.rows_of(batches):
            for some in zip(*(row[f"event_{k}"] for k in ("context", "own", "pair", "n"))):
                context, own, pair = (W.unpacked(v, "u8").astype("i8") for v in some[:3])
                bucket = _bucket(context)
                shares = weights[:, bucket] * _estimates(context, own, pair, tokens, distinct)
                shares *= W.unpacked(some[3], "u4") / shares.sum(axis=0)
                sums += [np.bincount(bucket, s, BUCKETS) for s in shares]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS, dtype="i4")), *map(pa.array, sums)], names=["bucket", "s0", "s1", "s2"])

    for _ in range(ROUNDS):
        got = events.mapInArrow(expected, "bucket int, s0 double, s1 double, s2 double").groupBy("bucket").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(3)]).collect()
        sums = np.ones((3, BUCKETS))  # one more of each, so that no estimate is ruled out
        sums[0, 0] = 0
        for r in got:
            sums[:, r["bucket"]] += r["s0"], r["s1"], r["s2"]
        new = sums / sums.sum(axis=0)
        moved, weights = np.abs(new - weights).max(), new
        if moved < STILL:
            break
    return weights


def learn(docs: DataFrame, part: Column, id_col: str = "doc_id", text_col: str = "text") -> tuple[Model, DataFrame]:
    """The model, and the corpus with the counts at every place (for ``scores``)."""
    sliced = stored(_sliced(docs, part, id_col, text_col), "lm-slices", "zstd")
    ends0, ends1, tokens = (v or 0 for v in sliced.agg(F.sum("docs0"), F.sum("docs1"), F.sum("tokens")).first())
    buckets = max(1, -(-tokens // W.BUCKET_WORDS))
    words = stored(_answered(_words_asked(sliced, buckets), True), "lm-words")
    size = words.where("slice is null").agg(*[F.sum(c) for c in ("tokens0", "tokens1", "distinct0", "distinct")]).first()
    tokens0, tokens1, distinct0, distinct = (v or 0 for v in size)
    pairs = _answered(_pairs_asked(sliced, buckets), False)
    told = words.unionByName(pairs).where("slice is not null").select("slice", "bucket", "words", "c0", "c1")
    counted = stored(_counted(sliced, told, buckets, (ends0, ends1)), "lm-counts")
    weights = _fitted(counted, tokens0 + ends0, distinct0 + (ends0 > 0))
    return Model(tokens0 + tokens1 + ends0 + ends1, distinct + (ends0 + ends1 > 0), ends0 + ends1, weights), counted


def scores(counted: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """Scores of the corpus's documents under the model."""
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = counted.schema["ids"].dataType.elementType
    id_wire, shares = to_arrow_type(id_type), model.tokens + model.distinct + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in W.rows_of(batches):
            lengths = W.unpacked(row["lengths"], "u4").astype("i8")
            stops = np.cumsum(lengths)
            starts = stops - lengths
            known, base, score = (np.zeros(len(lengths) + 1, t) for t in ("i8", "f8", "f8"))
            doc = np.repeat(np.arange(len(lengths)), lengths)
            ends, before, lo = model.ends, model.ends, 0  # a document begins after an end
            for own, pair in zip(row["own"], row["pair"]):
                own, pair = W.unpacked(own, "u8").astype("i8"), W.unpacked(pair, "u8").astype("i8")
                context = np.concatenate(([before], own[:-1]))
                first = starts[np.searchsorted(starts, lo):np.searchsorted(starts, lo + len(own))] - lo
                context[first] = ends
                chance = (model.weights[:, _bucket(context)] * _estimates(context, own, pair, model.tokens, model.distinct)).sum(axis=0)
                which = doc[lo:lo + len(own)]
                for total, value in ((known, own > 0), (base, np.log10((own + 1) / shares)), (score, np.log10(chance))):
                    total[which[0]:which[-1] + 1] += np.bincount(which - which[0], value).astype(total.dtype)
                before, lo = own[-1], lo + len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], id_wire), pa.array(np.frombuffer(row["parts"], "u1") == HELD_OUT), pa.array(lengths), pa.array(known[:-1]),
                 pa.array(np.full(len(lengths), model.tokens, "i8")), pa.array(base[:-1]), pa.array(score[:-1])],
                names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
        give_back()

    return counted.select("ids", "parts", "lengths", "own", "pair").mapInArrow(run, f"`{id_col}` {id_type.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def lm_scores(docs: DataFrame, part: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``part`` says what a document is for: ``ESTIMATES``, ``WEIGHTS`` or
    ``HELD_OUT`` (null: estimates).  A null text is empty: its end is its only
    token.  Repeated rows count and are scored as often as they stand there;
    other columns are not read; an empty table gives no rows.  Without documents
    for the weights the estimates count alike.  ``base_score`` adds one to every
    token's count, ``score`` is the model's; both are sums of log10.
    """
    model, counted = learn(docs, part, id_col, text_col)
    return scores(counted, model, id_col)
