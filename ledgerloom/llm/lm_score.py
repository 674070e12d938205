"""Language-model scores from Brown class-based bigrams.

Exchange clustering assigns words to classes: starting from the most frequent
words, each a class of its own, each round counts, over the whole training
text, how often each word follows and precedes each class, then takes words
(all in the first round, a drawn half in others) out of their classes, most
frequent first, and puts each into the one in which the class-bigram
likelihood is largest. The round with the best likelihood is kept. A text's probability multiplies class transitions and word emissions,
interpolated with the unigram:

    P(w | v) = (n(w) + 0.5) * (a * T[c(v), c(w)] / D[c(w)] + (1 - a) / D)

T are smoothed transitions between classes, D[c] and D the smoothed sums of
counts of a class and of all words, and a is fitted leaving each token out.
Over all words known, the end, and one unknown word, they sum to one. Since
n(w) stands outside, a text's score is the sum of log10(n(w) + 0.5) and of one
matrix entry per transition.

Counts of all words come from one aggregation over all training text. Words
are 64-bit codes. The head, words that make up one in HEAD of the tokens (so
never more words than HEAD), is broadcast, and a second pass over the texts
writes each as numbers of the head's words; all else reads those. Exchange
clustering moves the CLUSTERED most frequent words; every other word seen
LEAST_SEEN times, in the head or not, then gets the best class for its own
contexts by the finished class counts, in a distributed table. Counts and
classes of words outside the head reach the documents by one join, whatever
their number, and class bigrams are counted anew with all classes.

Defined cases: a null text counts as empty and is one end token. Words not in
the training text have count 0. With no training text all probabilities are
those of the base with N = V = 0. Rows that repeat a document are each
scored, and each counted if trained on. An empty table gives no rows. Columns
other than the id and the text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mapped, saved
from .wordcode import CodeIndex, chunks, word_codes

#: Words of the head make up one in HEAD of the tokens; so many of them at most are moved by clustering, the others are placed once it is done.
HEAD, CLUSTERED = 1 << 21, 1 << 15
CLASSES, ROUNDS = 46, 5
#: Words seen less often say too little of their contexts: they are of the class of others, which so learns where rare words stand.
LEAST_SEEN = 4
#: Transitions of a class are smoothed by so many drawn from all classes.
PRIOR = 20.0
#: The end of a text is a token of its own, with this code; its number is 0, those of the head's words follow.
END = np.uint64(1)
#: Tokens that a task looks at at a time, and words of which counts travel together.
TOKENS, BLOCK = 1 << 20, 1024
_WIDE = 0xFFFF  # stands for a number that does not fit in two bytes


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def _with_ends(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words of all texts, each text followed by END, and the number of the text of each."""
    codes, of = word_codes(texts)
    last = np.searchsorted(of, np.arange(len(texts)), side="right")
    return np.insert(codes, last, END), np.insert(of, last, np.arange(len(texts)))


def token_counts(texts: DataFrame) -> DataFrame:
    """`texts` (text) to code, n: how often each token occurs in all of them."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> pa.RecordBatch:
            codes, of = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            n = np.bincount(of, np.concatenate([h[1] for h in held])).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(n)], names=["code", "n"])

        for batch in batches:
            for _, some in chunks(_texts(batch.column(0))):
                codes, n = np.unique(_with_ends(some)[0], return_counts=True)
                held.append((codes, n))
                size += len(codes)
                if size > 2_000_000:
                    yield merged()
                    held, size = [], 0
        if held:
            yield merged()

    return texts.transform(mapped, counted, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


# ---- texts as numbers ----------------------------------------------------------------------------------------------------

#: short: a token's number in two bytes, or _WIDE; more: those that _WIDE stands for, in four. Words outside the head are -1 less their
#: place in codes, which has the different ones of the text. moves: left and right side of each transition to or from such a word.
_NUMBERED = "short binary, more binary, codes binary, moves binary"


def _binary(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Bytes of runs of `flat`, so many elements in each."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * flat.itemsize
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))])


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The elements of all rows of a binary column, and how many each row has."""
    if not len(column):
        return np.zeros(0, kind), np.zeros(0, np.int64)
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    size = np.dtype(kind).itemsize
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].copy().view(kind), np.diff(ends) // size


def numbered(docs: DataFrame, known: Broadcast) -> DataFrame:
    """`docs` (text and others) with _NUMBERED and a number of its own for each row in place of the text."""
    kept = [c for c in docs.columns if c != "text"]
    at = docs.columns.index("text")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = known.value
        for batch in batches:
            others = [c for i, c in enumerate(batch.columns) if i != at]
            for first, some in chunks(_texts(batch.column(at))):
                size = len(some)
                codes, of = _with_ends(some)
                number = index.find(codes).astype(np.int64) + 1
                number[codes == END] = 0
                rest = np.flatnonzero((number == 0) & (codes != END))
                order = np.lexsort((codes[rest], of[rest]))
                here, texts = codes[rest[order]], of[rest[order]]
                new = np.append(True, (here[1:] != here[:-1]) | (texts[1:] != texts[:-1]))[: len(here)]
                held = np.bincount(texts[new], minlength=size)
                number[rest[order]] = -1 - (np.cumsum(new) - 1 - (np.cumsum(held) - held)[texts])
                wide = (number < 0) | (number >= _WIDE)
                left = np.concatenate([[0], number[:-1]])  # the token before a text's first is the end of the one before it
                moved = np.flatnonzero((number < 0) | (left < 0))
                columns = [
                    _binary(np.where(wide, _WIDE, number).astype("<u2"), np.bincount(of, minlength=size)),
                    _binary(number[wide].astype("<i4"), np.bincount(of[wide], minlength=size)),
                    _binary(here[new].view(np.int64), held),
                    _binary(np.stack([left[moved], number[moved]], 1).astype("<i4").reshape(-1), 2 * np.bincount(of[moved], minlength=size)),
                ]
                yield pa.RecordBatch.from_arrays([*(c[first : first + size] for c in others), *columns], names=[*kept, "short", "more", "codes", "moves"])

    from pyspark.sql import types as T

    schema = T.StructType([*(docs.schema[c] for c in kept), *T._parse_datatype_string(_NUMBERED).fields])
    # Numbers of rows are fixed once they are written.
    return saved(docs.transform(mapped, coded, schema).withColumn("row", F.monotonically_increasing_id()), "numbered")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of batches that begin with short and more, with about TOKENS tokens each: their numbers, and how many each row has."""
    for batch in batches:
        ends = np.cumsum(_flat(batch.column(0), "<u2")[1])
        first = 0
        while first < len(batch):
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + TOKENS, side="right")))
            part = batch.slice(first, last - first)
            short, counts = _flat(part.column(0), "<u2")
            number = short.astype(np.int32)
            number[short == _WIDE] = _flat(part.column(1), "<i4")[0]
            yield part, number, counts
            first = last


def _kinds(number: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of tokens and of those before them; `label` has that of words outside the head last. An end comes before all."""
    kind = label[np.maximum(number, -1)].astype(np.int64)
    return kind, np.concatenate([[label[0]], kind[:-1]])


# ---- clustering ----------------------------------------------------------------------------------------------------------


def _contexts(texts: DataFrame, label: np.ndarray, clustered: int, kinds: int, tail: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How often each clustered word follows and precedes each class, other than itself; itself; and class bigrams, with or without those of words outside the head (`tail`).

    `label`: classes by number, then that of words outside the head. Over all of `texts` (short, more).
    """
    blocks = -(-clustered // BLOCK)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 2 * kinds + 1
        context = np.zeros(blocks * BLOCK * width, np.int64)
        pairs = np.zeros(kinds * kinds, np.int64)
        for _, number, _ in _parts(batches):
            kind, before = _kinds(number, label)
            left = np.concatenate([[0], number[:-1]])
            counted_ = slice(None) if tail else (left >= 0) & (number >= 0)
            pairs += np.bincount((before * kinds + kind)[counted_], minlength=kinds * kinds)
            if clustered:
                mine = np.flatnonzero((number > 0) & (number <= clustered))
                word, after = (number[mine].astype(np.int64) - 1) * width, np.append(kind[1:], label[0])[mine]
                again = number[mine] == left[mine]
                np.add.at(context, word[~again] + before[mine][~again], 1)
                np.add.at(context, word[again] + 2 * kinds, 1)
                follows = np.append(number[1:], 0)[mine] != number[mine]
                np.add.at(context, word[follows] + kinds + after[follows], 1)
        for block, part in enumerate(context.reshape(blocks, -1) if blocks else ()):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=["block", "counts"])
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([zlib.compress(pairs.tobytes(), 1)], pa.binary())], names=["block", "counts"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                got = np.frombuffer(zlib.decompress(counts.as_py()), np.int64)
                total[block] = total[block] + got if block in total else got
        for block, part in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names=["block", "counts"])

    # The driver gets one row a block of clustered words.
    table = texts.select("short", "more").transform(mapped, counted, "block int, counts binary").repartition("block").transform(mapped, summed, "block int, counts binary")
    context, pairs = np.zeros((blocks, BLOCK, 2 * kinds + 1)), np.zeros((kinds, kinds))
    for row in table.collect():
        got = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
        if row["block"] < 0:
            pairs = got.reshape(kinds, kinds).astype(float)
        else:
            context[row["block"]] = got.reshape(BLOCK, -1)
    context = context.reshape(-1, 2 * kinds + 1)[:clustered]
    return context[:, :-1].reshape(clustered, 2, kinds), context[:, -1], pairs


def _g(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-9))


def likelihood(pairs: np.ndarray) -> float:
    """The class-bigram log-likelihood, but for what does not depend on classes."""
    return float(_g(pairs).sum() - _g(pairs.sum(0)).sum() - _g(pairs.sum(1)).sum())


def exchange(classes: np.ndarray, context: np.ndarray, pairs: np.ndarray, free: int, batch: int = 64, again: np.ndarray | None = None) -> np.ndarray:
    """Move words, in order, to the class of most likelihood among the first `free`; counts follow each batch of moves.

    A word is first taken out of its class. What it then adds in any class, its old one too, is the change of
    g(x) = x log x over the class's bigrams less that over both margins; the cell of the class with itself
    changes by both contexts at once. `again`: how often each word follows itself, which `context` leaves out.
    """
    classes, pairs = classes.copy(), np.array(pairs, float)
    again = np.zeros(len(classes)) if again is None else again
    each = np.arange(free)
    for a in range(0, len(classes), batch):
        mine = np.arange(a, min(a + batch, len(classes)))
        row, own = np.arange(len(mine)), classes[mine]
        b, f, s = context[mine, 0], context[mine, 1], again[mine]
        into, out = (np.repeat(x[None], len(mine), 0) for x in (pairs.T[:free], pairs[:free]))  # bigrams with the class second, and first
        into[row, :, own] -= f[:, :free]
        out[row, :, own] -= b[:, :free]
        held = np.flatnonzero(own < free)
        into[held, own[held]] -= b[held]
        out[held, own[held]] -= f[held]
        into[held, own[held], own[held]] -= s[held]
        out[held, own[held], own[held]] -= s[held]
        np.maximum(into, 0, out=into)
        np.maximum(out, 0, out=out)
        self_ = into[:, each, each]
        more_in, more_out = _g(into + b[:, None, :]) - _g(into), _g(out + f[:, None, :]) - _g(out)
        gain = more_in.sum(2) + more_out.sum(2) - more_in[:, each, each] - more_out[:, each, each]
        gain += _g(self_ + b[:, :free] + f[:, :free] + s[:, None]) - _g(self_)
        # Margins of the classes as they are once the word's neighbours have it back, wherever it goes.
        for total, added in ((into.sum(2) + f[:, :free], b.sum(1) + s), (out.sum(2) + b[:, :free], f.sum(1) + s)):
            gain -= _g(total + added[:, None]) - _g(total)
        gain[held, own[held]] += 1e-9
        best = gain.argmax(1)
        for i in np.flatnonzero(best != own):
            for kind, sign in ((own[i], -1), (best[i], 1)):
                pairs[:, kind] += sign * b[i]
                pairs[kind, :] += sign * f[i]
                pairs[kind, kind] += sign * s[i]
        np.maximum(pairs, 0, out=pairs)
        classes[mine] = best
    return classes


def _placed(texts: DataFrame, heads: Broadcast, label: np.ndarray, pairs: np.ndarray, kinds: int) -> DataFrame:
    """The words of the class of others, seen often enough, to code, n and the class (of the first `kinds`) that suits their contexts best."""
    other, width = kinds, 2 * (kinds + 2)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> pa.RecordBatch:
            """A word's contexts as slots, or, where they are many, as counts of all slots."""
            codes, slots = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            order = np.argsort(codes, kind="stable")
            words, n = np.unique(codes[order], return_counts=True)
            often = np.flatnonzero(n > width)
            long = np.repeat(n > width, n)
            row = np.repeat(np.arange(len(words)), n)[long]
            counts = np.zeros((len(words) if len(often) else 0, width), "<u4")
            for side in (0, 1):
                np.add.at(counts, (row, slots[order][long][:, side]), 1)
            few = _binary(slots[order][~long].reshape(-1), np.where(n > width, 0, 2 * n))
            many = _binary(counts[often].reshape(-1), np.where(n > width, width, 0))
            return pa.RecordBatch.from_arrays([pa.array(words), few, many], names=["code", "few", "many"])

        for part, number, counts in _parts(batches):
            kind, before = _kinds(number, label)
            mine = np.flatnonzero(kind == other)
            codes, own = _flat(part.column(2), "<i8")
            here, of = number[mine], np.repeat(np.arange(len(counts)), counts)[mine]
            tail = here < 0
            code = np.empty(len(mine), np.int64)
            code[~tail] = heads.value[here[~tail]]
            code[tail] = codes[(np.cumsum(own) - own)[of[tail]] - 1 - here[tail]]
            slots = np.stack([before[mine], kinds + 2 + np.append(kind[1:], label[0])[mine]], 1).astype(np.uint8)
            held.append((code, slots))
            size += len(code)
            if size > 1_000_000:
                yield merged()
                held, size = [], 0
        if size:
            yield merged()

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.zeros(0, np.int64), np.zeros((0, width))

        def chosen(codes: np.ndarray, context: np.ndarray) -> Iterator[pa.RecordBatch]:
            seen = context.sum(1).astype(np.int64) // 2  # each occurrence has one context before and one after
            often = np.flatnonzero(seen >= LEAST_SEEN)
            for first in range(0, len(often), 512):
                some = often[first : first + 512]
                kind = exchange(np.full(len(some), other), context[some].reshape(-1, 2, kinds + 2), pairs, kinds, len(some))
                yield pa.RecordBatch.from_arrays([pa.array(codes[some]), pa.array(seen[some]), pa.array(kind.astype(np.int32))], names=["code", "n", "kind"])

        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                code = part.column(0).to_numpy()
                codes, of = np.unique(np.concatenate([rest[0], code]), return_inverse=True)
                context = np.zeros((len(codes), width))
                context[of[: len(rest[0])]] = rest[1]
                of = of[len(rest[0]) :]
                slots, n = _flat(part.column(1), "u1")
                np.add.at(context, (np.repeat(of, n), slots), 1)
                counts, n = _flat(part.column(2), "<u4")
                np.add.at(context, of[n > 0], counts.reshape(-1, width))
                last = codes == code[-1]  # its rows may go on
                yield from chosen(codes[~last], context[~last])
                rest = codes[last], context[last]
        yield from chosen(*rest)

    few = texts.select("short", "more", "codes").transform(mapped, met, "code bigint, few binary, many binary")
    return few.repartition("code").sortWithinPartitions("code").transform(mapped, best, "code bigint, n bigint, kind int")


def _resolved(texts: DataFrame, tail: DataFrame, label: np.ndarray) -> DataFrame:
    """Rows of `texts` (row, held_out, codes, moves) that have words outside the head, to row, held_out, tail_known, tail_logs and cells.

    `tail` (code, n, kind) has those words' counts and classes; cells are the classes of both sides of their transitions.
    """
    some = texts.where(F.length("codes") > 0)
    other = int(label[-1])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, n = _flat(batch.column(1), "<i8")
            place = np.arange(len(codes)) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), n)), pa.array(place.astype(np.int32)), pa.array(codes)], names=["of", "place", "code"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            moves, sides = _flat(batch.column(2), "<i4")
            lists = batch.column(3)
            fields = lists.flatten()
            place, count, kind = (fields.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            each = np.diff(lists.offsets.to_numpy())
            begin = np.cumsum(each) - each
            counts, kinds = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
            at = np.repeat(begin, each) + place
            counts[at], kinds[at] = count, kind
            of = np.repeat(np.arange(len(batch)), sides)
            rare = moves < 0
            cells = np.empty(len(moves), np.uint8)
            cells[~rare] = label[moves[~rare]]
            cells[rare] = kinds[begin[of[rare]] - 1 - moves[rare]]
            right = rare.copy()
            right[::2] = False  # each token is the right side of one transition
            n = counts[begin[of[right]] - 1 - moves[right]]
            known, logs = np.bincount(of[right], n > 0, len(batch)).astype(np.int64), np.bincount(of[right], np.log10(n + 0.5), len(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(known, pa.int64()), pa.array(logs, pa.float64()), _binary(cells, sides)], names=["row", "held_out", "tail_known", "tail_logs", "cells"])

    words = some.select("row", "codes").transform(mapped, listed, "of bigint, place int, code bigint")
    met = words.join(tail, "code", "left").select("of", F.struct("place", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("kind", F.lit(other)).alias("kind")).alias("w"))
    lists = met.groupBy("of").agg(F.collect_list("w").alias("w"))
    both = some.select("row", "held_out", "moves").join(lists, F.col("row") == F.col("of")).select("row", "held_out", "moves", "w")
    return saved(both.transform(mapped, joined, "row bigint, held_out boolean, tail_known bigint, tail_logs double, cells binary"), "tail-words")


def _cell_counts(resolved: DataFrame, kinds: int) -> np.ndarray:
    """Class bigrams of the transitions in `cells`."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(kinds * kinds, np.int64)
        for batch in batches:
            cells = _flat(batch.column(0), "u1")[0].reshape(-1, 2).astype(np.int64)
            total += np.bincount(cells[:, 0] * kinds + cells[:, 1], minlength=kinds * kinds)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["cell", "n"])

    pairs = np.zeros(kinds * kinds)
    for r in resolved.select("cells").transform(mapped, counted, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        pairs[r["cell"]] = r["n"]
    return pairs.reshape(kinds, kinds)


# ---- the model -----------------------------------------------------------------------------------------------------------


@dataclass
class Model:
    """Logs of counts by number; classes by number, then that of words outside the head; log10 of what a transition multiplies n(w) + 0.5 by."""

    logs: np.ndarray
    label: np.ndarray
    table: np.ndarray
    ends: int
    tokens: int
    types: int

    @property
    def base_divisor(self) -> float:
        return self.tokens + 0.5 * (self.types + 1)


def _class_weight(pairs: np.ndarray, share: np.ndarray, mass: np.ndarray, base: float, steps: int = 25) -> float:
    """The interpolation weight of most likelihood, by EM over class bigrams of which each token sees all others."""
    weight, moves = 0.5, (np.maximum(pairs - 1, 0) + PRIOR * share) / (np.maximum(pairs.sum(1, keepdims=True) - 1, 0) + PRIOR)
    by_class = moves / np.maximum(mass, 0.5)
    for _ in range(steps if pairs.sum() else 0):
        part = weight * by_class / (weight * by_class + (1 - weight) / base)
        weight = float((pairs * part).sum() / pairs.sum())
    return min(weight, 0.99)


def transitions(pairs: np.ndarray, mass: np.ndarray, types: np.ndarray, base: float) -> np.ndarray:
    """What a transition between classes multiplies a word's n + 0.5 by. `mass` and `types` of the classes count the unknown word with the others."""
    share = (pairs.sum(0) + 0.5 * types) / (pairs.sum() + 0.5 * types.sum())
    weight = _class_weight(pairs, share, mass, base)
    moves = (pairs + PRIOR * share) / (pairs.sum(1, keepdims=True) + PRIOR)
    return weight * moves / np.maximum(mass, 0.5) + (1 - weight) / base


def _head(counts: DataFrame, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Codes and counts of the words seen `floor` times or more, most frequent first; and how many texts end."""
    table = counts.where((F.col("n") >= floor) | (F.col("code") == int(END))).toArrow()
    codes, n = table["code"].to_numpy().view(np.uint64), table["n"].to_numpy()
    ends, words = int(n[codes == END].sum()), codes != END
    codes, n = codes[words], n[words]
    order = np.lexsort((codes, -n))
    return codes[order], n[order], ends


def lm_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD, clustered: int = CLUSTERED, kinds: int = CLASSES, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of `docs`, scored by a model of the rows that are not `held_out`: its tokens, those known, and both scores."""
    slim = docs.select(F.col(id_col).alias("doc_id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    counts = saved(token_counts(slim.where("NOT held_out").select("text")), "token-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("types")).first()
    tokens, types_ = total["tokens"], total["types"]
    floor = max(1, -(-tokens // head)) if head else 2**62
    codes, n, ends = _head(counts, floor)
    context = docs.sparkSession.sparkContext
    known, heads = context.broadcast(CodeIndex(codes)), context.broadcast(np.concatenate([[0], codes.view(np.int64)]))
    texts = numbered(slim, known)
    training = texts.where("NOT held_out")

    clustered, other, end = min(clustered, int((n >= LEAST_SEEN).sum())), kinds, kinds + 1
    label = np.full(len(codes) + 2, other, np.uint8)  # by number; the last is for words outside the head
    label[0] = end
    seeds = min(clustered, kinds)
    label[1 : seeds + 1] = np.arange(seeds)  # the first round places all others by the most frequent words
    best = None
    for round_ in range(rounds + 1 if clustered else 0):
        last = round_ == rounds
        around, again, pairs = _contexts(training, label, 0 if last else clustered, kinds + 2)
        if best is None or likelihood(pairs) > best[0]:
            best = likelihood(pairs), label.copy(), pairs
        if not last:
            # Contexts are those of the round's start: after the first round half of the words stay, so that the others' are not all out of date.
            mine = np.arange(clustered) if not round_ else np.flatnonzero(np.random.default_rng(round_).random(clustered) < 0.5)
            label[1 + mine] = exchange(label[1 + mine].astype(np.int64), around[mine], pairs, kinds, again=again[mine])
    tail = counts.where((F.col("n") < floor) & (F.col("code") != int(END)))
    if best is not None:
        _, label, pairs = best
        placed = saved(_placed(training, heads, label, pairs, kinds), "placed-words")
        here = placed.where(F.col("n") >= floor).toArrow()  # of the head, so never more
        label[known.value.find(here["code"].to_numpy().view(np.uint64)) + 1] = here["kind"].to_numpy()
        tail = saved(tail.join(placed.select("code", "kind"), "code", "left").select("code", "n", F.coalesce("kind", F.lit(other)).alias("kind")), "tail")
    else:
        tail = tail.withColumn("kind", F.lit(other))
    resolved = _resolved(texts, tail, label)

    _, _, pairs = _contexts(training, label, 0, kinds + 2, tail=False)
    pairs = pairs + _cell_counts(resolved.where("NOT held_out"), kinds + 2)
    mass = np.bincount(label[:-1], np.concatenate([[ends], n]) + 0.5, kinds + 2)
    types = np.bincount(label[:-1], minlength=kinds + 2)
    for r in tail.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        mass[r["kind"]] += r["n"] + 0.5 * r["words"]
        types[r["kind"]] += r["words"]
    mass[other] += 0.5  # the unknown word is of the class of others
    types[other] += 1
    if not ends:  # nothing to learn from: the end counts among the unknown
        mass[end], types[end] = 0.5, 0
    table = np.log10(transitions(pairs, mass, types, tokens + 0.5 * (types_ + 1)))
    return score_texts(texts, Model(np.log10(np.concatenate([[ends], n]) + 0.5), label, table, ends, tokens, types_), resolved)


def score_texts(texts: DataFrame, model: Model, resolved: DataFrame) -> DataFrame:
    """`numbered` texts (doc_id, held_out) with n_tokens, n_known, train_tokens, base_score and score."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs_of = np.append(model.logs, 0.0)  # the last is for words outside the head
        for part, number, counts in _parts(batches):
            size, of = len(counts), np.repeat(np.arange(len(counts)), counts)
            kind, before = _kinds(number, model.label)
            seen = (number >= 0) & (np.concatenate([[0], number[:-1]]) >= 0)
            moves = np.bincount(of[seen], model.table[before[seen], kind[seen]], size)
            known = number > 0 if not model.ends else number >= 0
            columns = [np.bincount(of, minlength=size), np.bincount(of[known], minlength=size), np.bincount(of, logs_of[np.maximum(number, -1)], size), moves]
            yield pa.RecordBatch.from_arrays([*part.columns[2:], *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.float64()), strict=True))], names=["row", "doc_id", "held_out", "n_tokens", "n_known", "logs", "moves"])

    def gained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, n = _flat(batch.column(3), "u1")
            cells = cells.reshape(-1, 2)
            gain = np.bincount(np.repeat(np.arange(len(n)), n // 2), model.table[cells[:, 0], cells[:, 1]], len(n))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(gain, pa.float64())], names=["of", "tail_known", "tail_logs", "gain"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    head = texts.select("short", "more", "row", "doc_id", "held_out").transform(mapped, scored, f"row bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, logs double, moves double")
    rest = resolved.select("row", "tail_known", "tail_logs", "cells").transform(mapped, gained, "of bigint, tail_known bigint, tail_logs double, gain double")
    logs = F.col("logs") + F.coalesce("tail_logs", F.lit(0.0))
    return head.join(rest, F.col("row") == F.col("of"), "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(float(np.log10(model.base_divisor)))).alias("base_score"),
        (logs + F.col("moves") + F.coalesce("gain", F.lit(0.0))).alias("score"),
    )
