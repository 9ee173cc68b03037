"""Byte-level BPE vocabularies of the `tokenizers` JSON format, for use inside tasks.

A worker process reads a vocabulary once.  Nothing here encodes a whole corpus: the
operators call these small helpers on the batches that Spark hands them.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import cached_property, lru_cache

import numpy as np

KEY = 20                      # a pair of ids as one number: left << KEY | right
NEVER = 1 << 30
SHORT_WORD = 24               # bytes up to which a plain scan merges faster than a heap
# The words of the byte-level pre-tokenizer (fixed value), for characters that Python
# classes alike; the others are replaced by a stand-in of the right class first.
WORDS = re.compile(r" ?[^\W\d_]+| ?\d+|'(?:s|t|re|ve|m|ll|d)| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
STAND_IN = {"letter": "a", "number": "0", "other": "!", "space": "\t"}
CACHE_WORDS = 500_000         # bound of a worker's memory of words; forgotten words are computed again


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes: printable ones for themselves, the others from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and word splitting of one file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = _byte_alphabet()
        self.size = 1 + max([*spec["model"]["vocab"].values(), *(a["id"] for a in spec["added_tokens"])])
        self.bytes: list[bytes] = [b""] * self.size
        names = spec["model"]["vocab"]
        for name, number in names.items():
            self.bytes[number] = bytes(alphabet[c] for c in name)
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        for content, number in self.added.items():
            self.bytes[number] = content.encode()
        self._added_split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.left = np.full(self.size, -1, np.int32)
        self.right = np.full(self.size, -1, np.int32)
        self.born = np.full(self.size, -1, np.int64)
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = (names[x] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            whole = names[(pair[0] + pair[1]) if isinstance(pair, list) else pair.replace(" ", "")]
            self.merges[a << KEY | b] = (rank, whole)
            if self.left[whole] < 0:
                self.left[whole], self.right[whole], self.born[whole] = a, b, rank
        self.single = [0] * 256
        for number, content in enumerate(self.bytes):
            if len(content) == 1:
                self.single[content[0]] = number
        specials = set(self.added.values())
        # Tokens that merging never produces on their own bytes can not occur in an encoding.
        self.ids = {content: number for number, content in enumerate(self.bytes)
                    if content and number not in specials and self.merged(content) == [number]}
        # How long a token can be that begins, or ends, with given bytes; 2 where none are listed.
        self.ahead: dict[bytes, int] = {}
        self.behind: dict[bytes, int] = {}
        for content in self.ids:
            if len(content) > 2:
                self.ahead[content[:3]] = max(self.ahead.get(content[:3], 0), len(content))
                self.behind[content[-3:]] = max(self.behind.get(content[-3:], 0), len(content))
        self._probe = Tokenizer.from_file(path).pre_tokenizer
        self._known: set[str] = set()
        self._odd: dict[int, str] = {}

    # Words -------------------------------------------------------------------------

    def _class_of(self, c: str) -> str:
        """The class that the file's own pre-tokenizer gives a character."""
        def joined(before: str) -> bool:
            return len(self._probe.pre_tokenize_str(before + c)) == 1
        return "letter" if joined("b") else "number" if joined("1") else "other" if joined("!") else "space"

    def _learn(self, characters: set[str]) -> None:
        for c in characters:
            true = self._class_of(c)
            ours = "space" if c.isspace() else "number" if c.isdecimal() else "letter" if c.isalnum() else "other"
            if true != ours:
                self._odd[ord(c)] = STAND_IN[true]
            self._known.add(c)

    def words(self, text: str) -> list[str]:
        """The pre-tokenizer's words of a text without added tokens; together they are the text."""
        characters = set(text)
        if not characters <= self._known:
            self._learn(characters - self._known)
        if self._odd and not characters.isdisjoint(map(chr, self._odd)):
            found, at = [], 0
            for word in WORDS.findall(text.translate(self._odd)):
                found.append(text[at:at + len(word)])
                at += len(word)
            return found
        return WORDS.findall(text)

    def split_added(self, text: str) -> list[str]:
        """Text and added tokens by turns: even places are text, odd places added tokens."""
        return self._added_split.split(text)

    # Merging and compatibility -------------------------------------------------------

    def merged(self, word: bytes) -> list[int]:
        """Exact merging: lowest rank first, leftmost first among equals."""
        ids = [self.single[b] for b in word]
        if len(ids) <= SHORT_WORD:
            return self._merged_short(ids)
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        merges, heap = self.merges, []
        for k in range(len(ids) - 1):
            found = merges.get(ids[k] << KEY | ids[k + 1])
            if found:
                heap.append((found[0], k, found[1], ids[k], ids[k + 1]))
        heapq.heapify(heap)
        while heap:
            _, k, whole, a, b = heapq.heappop(heap)
            n = after[k]
            if ids[k] != a or n >= len(ids) or ids[n] != b:
                continue
            ids[k], ids[n] = whole, -1
            after[k] = after[n]
            if after[k] < len(ids):
                before[after[k]] = k
            for x, y in ((before[k], k), (k, after[k])):
                if x >= 0 and y < len(ids):
                    found = merges.get(ids[x] << KEY | ids[y])
                    if found:
                        heapq.heappush(heap, (found[0], x, found[1], ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def _merged_short(self, ids: list[int]) -> list[int]:
        """Merging of a short word: look at every pair again after each merge."""
        find = self.merges.get
        while len(ids) > 1:
            rank, at, whole = NEVER, -1, -1
            for k in range(len(ids) - 1):
                found = find(ids[k] << KEY | ids[k + 1])
                if found and found[0] < rank:
                    rank, whole = found
                    at = k
            if at < 0:
                break
            ids[at:at + 2] = [whole]
        return ids

    def _spine(self, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per token: its edge pieces from the byte up to the whole (columns), and how many."""
        path = [np.arange(self.size, dtype=np.int32)]
        while (path[-1] >= 0).any():
            last = path[-1]
            path.append(np.where(last >= 0, side[np.maximum(last, 0)], -1))
        table = np.stack(path[:-1])
        depth = (table >= 0).sum(axis=0)
        flipped = np.full_like(table, -1)
        for level in range(len(table)):
            rows = np.nonzero(depth > level)[0]
            flipped[level, rows] = table[depth[rows] - 1 - level, rows]
        return flipped, depth

    @cached_property
    def spines(self) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        return self._spine(self.right), self._spine(self.left)

    @cached_property
    def _ranks(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.fromiter(self.merges, np.int64, len(self.merges))
        ranks = np.fromiter((r for r, _ in self.merges.values()), np.int64, len(self.merges))
        order = np.argsort(keys)
        return keys[order], ranks[order]

    def compatible_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which token pairs stay two tokens when their bytes are merged together.

        Both tokens grow from their edge bytes upwards, in the order of the merges.  The
        pair fails when, at some time, the piece that ends `a` and the piece that begins
        `b` merge with each other before either merges inside its own token; of equal
        ranks the leftmost wins.
        """
        (right, right_depth), (left, left_depth) = self.spines
        keys, ranks = self._ranks
        good = np.ones(len(a), bool)
        i, j = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        active = np.arange(len(a))
        while len(active):
            p, q, u, v = a[active], b[active], i[active], j[active]
            x, y = right[u, p].astype(np.int64), left[v, q].astype(np.int64)
            x_last, y_last = u + 1 >= right_depth[p], v + 1 >= left_depth[q]
            x_next = np.where(x_last, NEVER, self.born[right[np.minimum(u + 1, len(right) - 1), p]])
            y_next = np.where(y_last, NEVER, self.born[left[np.minimum(v + 1, len(left) - 1), q]])
            wanted = x << KEY | y
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            rank = np.where(keys[at] == wanted, ranks[at], NEVER)
            crossed = (rank < x_next) & (rank <= y_next) & (rank < NEVER)
            good[active[crossed]] = False
            first = x_next <= y_next
            i[active] += first
            j[active] += ~first
            active = active[~crossed & ~(x_last & y_last)]
        return good

    @cached_property
    def _edges(self) -> tuple[list, list]:
        """The spines as lists of (piece, rank of the merge that takes it in), made when asked for."""
        return [None] * self.size, [None] * self.size

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        memory = self._edges[side]
        if memory[token] is None:
            child = (self.right, self.left)[side]
            path, taken = [], NEVER
            while token >= 0:
                path.append((int(token), taken))
                taken, token = int(self.born[token]), child[token]
            memory[path[0][0]] = path[::-1]
            return path[::-1]
        return memory[token]

    def compatible(self, a: int, b: int) -> bool:
        """`compatible_pairs` for one pair."""
        ends, begins, i, j = self._edge(a, 0), self._edge(b, 1), 0, 0
        while True:
            x, x_next = ends[i]
            y, y_next = begins[j]
            found = self.merges.get(x << KEY | y)
            if found and found[0] < x_next and found[0] <= y_next:
                return False
            if x_next == y_next == NEVER:
                return True
            if x_next <= y_next:
                i += 1
            else:
                j += 1


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)
