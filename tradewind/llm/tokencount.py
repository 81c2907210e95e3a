"""Token counts of whole texts: batch encoding in an Arrow function that returns lengths only.

A task takes texts in batches of about the same number of bytes, whatever their number of rows;
texts longer than a batch are cut at safe boundaries first. A batch is split at white space by
Arrow, each distinct part is encoded once with the vocabulary's library, and a text's count is the
sum over its parts. Token ids never leave the library's call, and no row of text is shuffled.

Safe boundaries of the word vocabulary: it drops white space, so no token spans a blank; its
normal form joins a character only with marks after it; and it takes every digit by itself. So
a text may be cut at any ASCII blank and before any ASCII digit, which no special string contains.
A vocabulary that keeps white space has no such boundaries here: ``whole=True`` then encodes texts
uncut, still in batches of bounded bytes.
"""

import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# characters of text that are split and encoded together
BATCH = 1 << 22
# distinct parts per call of the library, and the most characters in one
CALL_PARTS, CALL_CHARS = 20_000, 1 << 20
# remembered counts of a task; it forgets all of them when there are more
REMEMBER = 1_000_000
# parts longer than this are not remembered
LONG_PART = 64

_SAFE = re.compile("(?<=[ \t\n\v\f\r])(?=[^ \t\n\v\f\r])|(?=[0-9])")


class _Counter:
    """Token counts of strings under one vocabulary."""

    def __init__(self, path: str):
        self.known: "dict[str, int]" = {}
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: model.encode(texts, num_threads=1)
        else:
            # the tasks of an executor already use its cores
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.encode = lambda texts: model.encode_batch_fast(texts, add_special_tokens=False)

    def lengths(self, texts: "list[str]") -> "list[int]":
        """The counts of the texts, encoded in calls of bounded size."""
        out, call, chars = [], [], 0
        for text in texts:
            if call and (len(call) >= CALL_PARTS or chars + len(text) > CALL_CHARS):
                out += map(len, self.encode(call))
                call, chars = [], 0
            call.append(text)
            chars += len(text)
        return out + [len(ids) for ids in self.encode(call)] if call else out

    def of_parts(self, parts: "list[str]") -> np.ndarray:
        """The counts of distinct parts; those met before are not encoded again."""
        if len(self.known) > REMEMBER:
            self.known.clear()
        new = [p for p in parts if p not in self.known]
        found = dict(zip(new, self.lengths(new)))
        counts = np.fromiter(
            (found[p] if p in found else self.known[p] for p in parts), np.int64, len(parts)
        )
        self.known.update((p, n) for p, n in found.items() if len(p) <= LONG_PART)
        return counts


@lru_cache(maxsize=2)
def _counter(path: str) -> _Counter:
    return _Counter(path)


def safe_pieces(text: str, size: int = BATCH) -> "Iterator[str]":
    """Consecutive pieces of the text, each cut at the first safe boundary from ``size`` on."""
    at = 0
    while len(text) - at > size and (cut := _SAFE.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def _balanced(texts: "Iterable[str | None]", cut: bool) -> "Iterator[tuple[list[int], list[str]]]":
    """(places of their texts, pieces) of consecutive texts, about ``BATCH`` characters each."""
    places, pieces, chars = [], [], 0
    for place, text in enumerate(texts):
        for piece in safe_pieces(text or "", BATCH) if cut else [text or ""]:
            if pieces and chars + len(piece) > BATCH:
                yield places, pieces
                places, pieces, chars = [], [], 0
            places.append(place)
            pieces.append(piece)
            chars += len(piece)
    if pieces:
        yield places, pieces


def _part_counts(pieces: "list[str]", counter: _Counter) -> np.ndarray:
    """Token counts of the pieces, from those of their distinct parts between ASCII blanks."""
    split = pc.ascii_split_whitespace(pa.array(pieces, pa.large_string()))
    parts = split.flatten().dictionary_encode()
    each = counter.of_parts(parts.dictionary.to_pylist())[parts.indices.to_numpy()]
    sums = np.concatenate([[0], np.cumsum(each)])
    ends = split.offsets.to_numpy() - split.offsets[0].as_py()
    return sums[ends[1:]] - sums[ends[:-1]]


def count_texts(texts: "Iterable[str | None]", n: int, path: str, whole: bool = False) -> np.ndarray:
    """Token counts of the ``n`` texts; null counts as empty."""
    counter = _counter(path)
    out = np.zeros(n, dtype=np.int64)
    for places, pieces in _balanced(texts, cut=not whole):
        counts = counter.lengths(pieces) if whole else _part_counts(pieces, counter)
        np.add.at(out, places, counts)
    return out


def token_count(text: Column, path: str, whole: bool = False) -> Column:
    """The number of tokens (long) of a text column; see ``token_counts``."""

    @F.arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            # texts become Python strings one after another, about BATCH characters at a time
            yield pa.array(count_texts((x.as_py() for x in batch), len(batch), path, whole))

    return counted(text)


def token_counts(
    docs: DataFrame,
    path: str,
    text: str = "text",
    limit: "int | None" = None,
    whole: bool = False,
    out: str = "tokens",
) -> DataFrame:
    """``docs`` with a struct ``out``: ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    The count is that of the library for the file (tokenizers for ``.json``, sentencepiece for
    ``.model``), without tokens added around the text; special strings inside it count as the
    library takes them by default. Null and empty texts have no bytes and no tokens. ``over_limit``
    is null without a limit. Rows keep their columns and their number, repeated rows too; a
    column already named ``out`` is an error, so that none is replaced.
    """
    if out.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the rows already have a column {out}")
    words = F.coalesce(F.col(text), F.lit(""))
    # named twice, evaluated once: Spark takes equal functions of equal columns together
    n = token_count(words, path, whole)
    return docs.withColumn(
        out,
        F.struct(
            F.octet_length(words).cast("long").alias("n_bytes"),
            n.alias("n_tokens"),
            (F.lit(None).cast("boolean") if limit is None else n > limit).alias("over_limit"),
        ),
    )
