"""Exact token counts at every prefix of a text, by prefix dynamic programming.

Inside a word, the encoding of each prefix ends in exactly one token: the one that may
stand after the last token of the shorter prefix it extends.  So the count at a prefix is
the count at that shorter prefix plus one, and one walk over a word gives the counts of all
its prefixes.  Words add up.  Stored counts answer how many tokens a prefix has and how
much of a text fits a budget, without encoding again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from footings.llm.vocabulary import CACHE_WORDS, KEY, Vocabulary, vocabulary


class PrefixCounter:
    """Counts of words and of their prefixes, remembered up to a bound."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self._pairs: dict[int, bool] = {}
        self.totals = _Memory(lambda word: int(self.prefixes(word.encode())[-1]))
        self.cuts = _Memory(lambda word: np.array(self._cut_word(word), np.int32).tobytes())

    def prefixes(self, word: bytes) -> list[int]:
        """Token counts of the first 0, 1, 2, … bytes of a word."""
        ids, behind, pairs = self.vocab.ids, self.vocab.behind, self._pairs
        if len(pairs) > 4 * CACHE_WORDS:
            pairs.clear()
        last, counts = [-1], [0]
        for end in range(1, len(word) + 1):
            for start in range(max(0, end - behind.get(word[max(0, end - 3):end], 2)), end):
                token = ids.get(word[start:end])
                if token is None:
                    continue
                if start:
                    key = last[start] << KEY | token
                    fits = pairs.get(key)
                    if fits is None:
                        fits = pairs[key] = self.vocab.compatible(last[start], token)
                    if not fits:
                        continue
                last.append(token)
                counts.append(counts[start] + 1)
                break
        return counts

    def total(self, text: str) -> int:
        if not text:
            return 0
        parts = self.vocab.split_added(text)
        return len(parts) // 2 + sum(
            sum(map(self.totals.__getitem__, self.vocab.words(part))) for part in parts[::2] if part)

    def at_prefixes(self, text: str) -> np.ndarray:
        """Token counts of the first 0, 1, 2, … code points of a text, each as the library would count it."""
        out, done = [np.zeros(1, np.int32)], 0
        before, start = "", 0
        for place, part in enumerate(self.vocab.split_added(text)):
            if place % 2:
                # A prefix that ends inside an added token is ordinary text.
                inside = [start + self.total((before + part)[:len(before) + cut]) for cut in range(1, len(part))]
                done += 1
                out.append(np.array([*inside, done], np.int32))
                continue
            before, start = part, done
            if part:
                counts = self._of_words(self.vocab.words(part))
                out.append(counts + np.int32(done))
                done += int(counts[-1])
        return np.concatenate(out)

    def _of_words(self, words: list[str]) -> np.ndarray:
        """Counts after 1, 2, … code points of neighbouring words: those of each word, moved by all words before it."""
        cut = list(map(self.cuts.__getitem__, words))
        counts = np.frombuffer(b"".join(cut), np.int32)
        sizes = np.fromiter(map(len, cut), np.int64, len(cut)) // 4
        ends = np.cumsum(sizes)
        totals = np.cumsum(counts[ends - 1], dtype=np.int32)
        out = counts + np.repeat(np.concatenate([[np.int32(0)], totals[:-1]]), sizes)
        blank = list(map(str.isspace, words))
        for k in [k for k, one in enumerate(blank) if one] if True in blank else []:
            if k + 1 < len(words) and words[k + 1][0].isspace():
                # At the end of a run of blanks the run is one word.
                run = words[k] + words[k + 1][0]
                out[ends[k]] = totals[k] + self.prefixes(run.encode())[-1] - counts[ends[k] - 1]
        return out

    def _cut_word(self, word: str) -> list[int]:
        """Counts after 1, 2, … code points of a word."""
        if word[0] == "'" and word[1:] in ("re", "ve", "ll"):
            # Half a contraction is a quote and a letter.
            return [1, self.totals["'"] + self.totals[word[1]], self.totals[word]]
        by_byte = self.prefixes(word.encode())
        if word.isascii():
            return by_byte[1:]
        ends = np.cumsum([len(c.encode()) for c in word])
        return [by_byte[e] for e in ends]


class _Memory(dict):
    """A dict that computes what it lacks and forgets everything at its bound."""

    def __init__(self, make):
        super().__init__()
        self._make = make

    def __missing__(self, word):
        if len(self) >= CACHE_WORDS:
            self.clear()
        made = self[word] = self._make(word)
        return made


_counters: dict[str, PrefixCounter] = {}


def _counter(path: str) -> PrefixCounter:
    if path not in _counters:
        _counters[path] = PrefixCounter(vocabulary(path))
    return _counters[path]


def prefix_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                  stored: bool = True) -> DataFrame:
    """Per document: key, n_bytes, n_tokens and, if `stored`, `counts`.

    `counts[p]` is the token count of the first p code points, as the tokenizer at `path`
    (byte-level BPE, `tokenizers` JSON) counts them; the last entry is `n_tokens`.

    * Null and empty texts have no bytes and no tokens, and counts [0].
    * Special strings inside texts are one token, as in the library; nothing is added or cut.
    * Rows are independent: repeated rows and null keys stay, extra columns are ignored,
      an empty table gives no rows.  Nothing is shuffled; a task holds one batch of texts
      and a bounded memory of words, whatever the length of the texts.
    """
    fields = [StructField(key, docs.schema[key].dataType), StructField("n_bytes", LongType()), StructField("n_tokens", LongType())]
    fields += [StructField("counts", ArrayType(IntegerType()))] if stored else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            for part in pieces(batch):
                texts = [t or "" for t in part.column(1).to_pylist()]
                columns = [part.column(0), pa.array([len(t.encode()) for t in texts], pa.int64())]
                if stored:
                    counts = [counter.at_prefixes(t) for t in texts]
                    ends = np.cumsum([0, *map(len, counts)]).astype(np.int32)
                    columns += [pa.array([int(c[-1]) for c in counts], pa.int64()),
                                pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(counts)))]
                else:
                    columns.append(pa.array([counter.total(t) for t in texts], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return docs.select(key, text).mapInArrow(run, StructType(fields))


def pieces(batch: pa.RecordBatch, rows: int = 256, size: int = 16_000_000) -> Iterator[pa.RecordBatch]:
    """A batch in slices of few rows and, but for single texts, few bytes: only those are Python objects at a time."""
    length_of = pc.list_value_length if pa.types.is_list(batch.schema.field(1).type) else pc.binary_length
    lengths = pc.fill_null(length_of(batch.column(1)), 0).to_pylist()
    start, held = 0, 0
    for at, length in enumerate(lengths):
        if at > start and (at - start == rows or held + length > size):
            yield batch.slice(start, at - start)
            start, held = at, 0
        held += length
    if start < len(lengths):
        yield batch.slice(start)


def tokens_of_prefix(counts: Column, characters: Column) -> Column:
    """Tokens of the first `characters` code points, from stored counts.

    Null where counts or `characters` are null or `characters` is negative; beyond the end, the count of the whole text.
    """
    return F.get(counts, F.least(characters, F.size(counts) - 1).cast("int"))


def longest_within(counts: Column, budget: int) -> Column:
    """The most code points a prefix within `budget` tokens can have, from stored counts.

    Counts may fall where a letter joins its word, so the last place within the budget is looked for.
    Null where counts are null or the budget is negative.
    """
    whole = F.size(counts) - 1
    last = F.array_max(F.transform(counts, lambda count, place: F.when(count <= budget, place)))
    return F.when(counts.isNull() | F.lit(budget < 0), F.lit(None)).when(F.get(counts, whole) <= budget, whole).otherwise(last)
