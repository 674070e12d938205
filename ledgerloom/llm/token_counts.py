"""How many tokens each whole text has, without keeping any of them.

Arrow functions encode where the rows are read and hand back lengths only, so
nothing but a few numbers a row leaves a task, and nothing is shuffled (a table
too small to occupy all cores is dealt out first). Within a task, texts are
grouped into runs of about a megabyte whatever their number, and a longer text
is cut into parts of that size at places where the tokenizer always cuts, so
that the counts of the parts add up to the count of the text and a task holds
one part at a time.

`.json` files are those of the tokenizers library; strings of added tokens that
stand in a text count as that token, which is the library's default. `.model`
files are sentencepiece's; their texts are encoded whole, since its merges have
no place that is always a boundary.

Defined cases: a null text counts as empty; an empty text has no tokens. Null
ids, repeated rows and ties each keep their row. An empty table gives no rows.
Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, spread
from .tokenizing import encoder
from .wordcode import chunks

#: Bytes of one run of texts, and of one part of a long text.
RUN = 1 << 20

Counter = Callable[[list[bytes | None]], np.ndarray]


def _json_counter(path: str) -> Counter:
    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens") or []
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        whole.no_truncation()
        whole.no_padding()
        return lambda texts: np.array([len(e.ids) for e in whole.encode_batch([(t or b"").decode("utf-8") for t in texts], add_special_tokens=False)], np.int64)
    known = encoder(path)
    strings = sorted((t["content"].encode() for t in added), key=len, reverse=True)
    marks = re.compile(b"|".join(map(re.escape, strings))) if strings else None

    def count(texts: list[bytes | None]) -> np.ndarray:
        parts: list[bytes] = []
        of: list[int] = []
        extra = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            between = marks.split(text) if text and marks else [text or b""]
            extra[i] = len(between) - 1
            for stretch in between:
                some = list(known.split(stretch, RUN))
                parts += some
                of += [i] * len(some)
        counts = [known.count_many(run) for _, run in chunks(parts, RUN)]
        return extra + np.bincount(of, np.concatenate(counts), len(texts)).astype(np.int64) if counts else extra

    return count


def _model_counter(path: str) -> Counter:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)

    def count(texts: list[bytes | None]) -> np.ndarray:
        return np.array([len(model.encode((t or b"").decode("utf-8"), num_threads=1)) for t in texts], np.int64)

    return count


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One counter per file and worker process."""
    if path not in _counters:
        _counters[path] = _model_counter(path) if path.endswith(".model") else _json_counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, and whether the tokens are more than `limit`."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            sizes, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for at in range(0, len(batch), 256):
                some = texts.slice(at, 256).to_pylist()
                sizes.append(np.fromiter((len(t or b"") for t in some), np.int64, len(some)))
                counts.append(counter(tokenizer_path)(some))
            n = np.concatenate(counts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(sizes)), pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return spread(slim).transform(mapped, count, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
