"""BPE encoding by speculation and verification, and decoding.

Greedy longest match proposes the tokens of every new word of a batch.  One vectorised
check then tests every adjacent pair of proposed tokens: a word all of whose pairs are
compatible is encoded right, since a valid encoding is unique.  Only words with a failing
pair are merged exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from footings.llm.tokencounts import pieces
from footings.llm.vocabulary import CACHE_WORDS, KEY, Vocabulary, vocabulary


class Encoder:
    """Encodes batches of texts; words already met are remembered up to a bound."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.memory: dict[str, tuple[int, ...]] = {}

    def _propose(self, word: bytes) -> list[int]:
        ids, ahead, found, at = self.vocab.ids, self.vocab.ahead, [], 0
        while at < len(word):
            end = min(len(word), at + ahead.get(word[at:at + 3], 2))
            while (token := ids.get(word[at:end])) is None:
                end -= 1
            found.append(token)
            at = end
        return found

    def learn(self, words: list[str]) -> None:
        """Encode words that are not in memory."""
        spelled = [w.encode() for w in words]
        proposed = [self._propose(w) for w in spelled]
        sizes = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter(chain.from_iterable(proposed), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(proposed)), sizes)
        inside = owner[1:] == owner[:-1]
        pairs, place = np.unique((flat[:-1] << KEY | flat[1:])[inside], return_inverse=True)
        good = self.vocab.compatible_pairs(pairs >> KEY, pairs & ((1 << KEY) - 1))
        failing = np.unique(owner[1:][inside][~good[place]])
        for k in failing.tolist():
            proposed[k] = self.vocab.merged(spelled[k])
        self.memory.update(zip(words, map(tuple, proposed)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        split = [self.vocab.split_added(t) if t else [] for t in texts]
        words = [[self.vocab.words(part) if k % 2 == 0 else part for k, part in enumerate(parts)] for parts in split]
        new = set()
        for parts in words:
            for part in parts[::2]:
                new.update(part)
        if len(self.memory) > CACHE_WORDS:
            # Frequent words are in nearly every batch and stay.
            self.memory = {w: self.memory[w] for w in new if w in self.memory}
        new.difference_update(self.memory)
        if new:
            self.learn(list(new))
        out, lookup, added = [], self.memory.__getitem__, self.vocab.added
        for parts in words:
            runs = [chain.from_iterable(map(lookup, part)) if k % 2 == 0 else (added[part],) for k, part in enumerate(parts)]
            out.append(np.fromiter(chain.from_iterable(runs), np.int32))
        return out


_encoders: dict[str, Encoder] = {}


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, `ids` array<int>, as the tokenizer at `path` encodes the whole text.

    * No special tokens are added, nothing is cut or padded; special strings inside texts
      become their token, as in the library.  Null and empty texts have no ids.
    * Rows are independent: repeated rows and null keys stay, extra columns are ignored,
      an empty table gives no rows.  Nothing is shuffled; a task holds some hundred texts
      and a bounded memory of words.
    """
    fields = [StructField(key, docs.schema[key].dataType), StructField("ids", ArrayType(IntegerType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = Encoder(vocabulary(path))
        for batch in batches:
            for part in pieces(batch):
                ids = _encoders[path].encode([t or "" for t in part.column(1).to_pylist()])
                offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                values = np.concatenate(ids) if ids else np.empty(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[f.name for f in fields])

    return docs.select(key, text).mapInArrow(run, StructType(fields))


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`encoded` with `text`: the text its ids stand for, bytes outside UTF-8 replaced as in the library.

    Null id lists give an empty text; ids outside the vocabulary stand for nothing.
    """
    fields = [*encoded.schema.fields, StructField(text, StringType())]
    place = encoded.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # An id outside the vocabulary is the last entry, which stands for nothing.
        spelled = [*vocabulary(path).bytes, b""]
        for batch in batches:
            for part in pieces(batch):
                lists = part.column(place)
                values = lists.values.to_numpy(zero_copy_only=False)
                values = np.where((values >= 0) & (values < len(spelled)), values, len(spelled) - 1)
                ends = lists.offsets.to_numpy()
                texts = [b"".join(map(spelled.__getitem__, values[a:b].tolist())).decode("utf-8", "replace")
                         for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[f.name for f in fields])

    return encoded.mapInArrow(run, StructType(fields))
