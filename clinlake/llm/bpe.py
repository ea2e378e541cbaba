"""Byte-level BPE encoding and decoding with a public vocabulary, by contiguous rank arrays.

A word is held as its parts and the ranks of its adjacent pairs. The lowest rank is found by a scan,
its boundary is deleted and the two neighbouring ranks are looked up again, until no pair has a rank.
Words that a batch has and the memory lacks take these steps side by side, as rows of one array.
Words of more than LONG_WORD bytes take the same merges from a heap, so that a megabyte without
white space stays near-linear. Words repeat, so each worker remembers the ids of up to twice MEMO words.

The vocabulary file is read on the driver and broadcast (its size is that of the vocabulary), because
executors may not see the driver's folders. Special tokens are matched in the text before the words
are cut, as the file's own library does by default.

Nulls: a null text is empty, with no ids. Very long texts and words are encoded whole. Repeated rows stay repeated.
An empty table gives an empty result. Extra columns pass through, but input columns that have the name of a new
one (ids, n_tokens, decoded) are replaced by it, unless it is the column that is read.
"""

from __future__ import annotations

import heapq
import json
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm import common

#: Widths of the arrays in which short words are merged side by side.
WIDTHS = (16, 40)
#: Words in one such array.
ABREAST = 8_192
LONG_WORD = 256
#: Texts whose words are looked up together.
TEXTS = 250
MEMO = 350_000
#: The words of this family of vocabularies: letters, digits or signs with a space before, English endings, white space.
WORDS = r" ?\p{L}++| ?\p{N}++|'(?:s|t|re|ve|m|ll|d)| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"
#: Letters and numbers that came after Unicode 16, whose tables the public library has, as first and
#: last code points. To it they are signs; the regular expressions here know them.
LATER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2),
    (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F),
    (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24),
    (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED),
    (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
_LATER = "".join(f"{chr(a)}-{chr(b)}" for a, b in LATER)
_HAS_LATER = regex.compile(f"[{_LATER}]")

#: Columns that encoding and decoding append.
ENCODED, DECODED = [("ids", "binary"), ("n_tokens", "bigint")], [("decoded", "string")]

_NEVER = 1 << 60


def byte_names() -> dict[str, int]:
    """The printable character by which vocabulary files name each byte: itself if visible, else 256 upwards."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {chr(b): b for b in visible}
    for n, b in enumerate(b for b in range(256) if b not in set(visible)):
        names[chr(256 + n)] = b
    return names


class Bpe:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        names = byte_names()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in merges)
        #: By left id * 2**32 + right id.
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for n, (a, b) in enumerate(pairs):
            self.rank[vocab[a] << 32 | vocab[b]] = n
            self.made.append(vocab[a + b])
        self.first = [0] * 256
        self.bytes = [b""] * (1 + max(chain(vocab.values(), (t["id"] for t in spec.get("added_tokens", [])))))
        for name, i in vocab.items():
            self.bytes[i] = bytes(names[c] for c in name) if all(c in names for c in name) else name.encode()
            if len(name) == 1 and name in names:
                self.first[names[name]] = i
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for text, i in self.special.items():
            self.bytes[i] = text.encode()
        longest = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        self._words = regex.compile(WORDS).findall
        known = [rf"(?:(?![{_LATER}])\p{{{c}}})++" for c in "LN"]
        sign = rf"(?:[{_LATER}]|[^\s\p{{L}}\p{{N}}])++"
        self._careful = regex.compile(WORDS.replace(r"\p{L}++|", known[0] + "|").replace(r"\p{N}++|", known[1] + "|").replace(r"[^\s\p{L}\p{N}]++", sign)).findall
        keys = sorted(self.rank)
        self.pair_key = np.array(keys, np.int64)
        self.pair_rank = np.array([self.rank[k] for k in keys], np.int64)
        self.first_np, self.made_np = np.array(self.first, np.int64), np.array(self.made, np.int64)
        self.memo = _Memo(self.word)

    def find(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        return self._words(text) if text.isascii() or not _HAS_LATER.search(text) else self._careful(text)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where(self.pair_key[at] == key, self.pair_rank[at], _NEVER)

    def _abreast(self, words: list[bytes], width: int) -> list[bytes]:
        """Packed ids of words of at most width bytes, merged row by row."""
        data = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        n = np.array([len(w) for w in words])
        column = np.arange(width)
        parts = self.first_np[data]
        ranks = np.full(parts.shape, _NEVER, np.int64)
        row, col = np.nonzero(column[None, : width - 1] < n[:, None] - 1)
        ranks[row, col] = self._ranks(parts[row, col], parts[row, col + 1])
        done, sizes, who = np.zeros(parts.shape, "<u4"), n.copy(), np.arange(len(words))
        while len(who):
            row = np.arange(len(who))
            at = ranks.argmin(1)
            low = ranks[row, at]
            live = low < _NEVER
            if not live.all():
                done[who[~live]], sizes[who[~live]] = parts[~live], n[~live]
                parts, ranks, n, who, at, low = parts[live], ranks[live], n[live], who[live], at[live], low[live]
                row = np.arange(len(who))
            parts[row, at] = self.made_np[low]
            parts = np.take_along_axis(parts, np.minimum(column + (column > at[:, None]), width - 1), 1)
            ranks = np.take_along_axis(ranks, np.minimum(column + (column >= at[:, None]), width - 1), 1)
            ranks[:, -1] = _NEVER
            n = n - 1
            after = at + 1 < n
            ranks[row, at] = np.where(after, self._ranks(parts[row, at], parts[row, np.minimum(at + 1, width - 1)]), _NEVER)
            r = row[at > 0]
            ranks[r, at[r] - 1] = self._ranks(parts[r, at[r] - 1], parts[r, at[r]])
        raw = done.tobytes()
        return [raw[i * width * 4 : (i * width + k) * 4] for i, k in enumerate(sizes.tolist())]

    def learn(self, words: set[str]) -> None:
        """Remember the ids of these words."""
        fresh = [w for w in words if w not in self.memo and len(w) <= WIDTHS[-1]]
        left = []
        for w in fresh:
            if (found := self.memo.old.get(w)) is not None:
                self.memo[w] = found
            else:
                left.append((w, w.encode("utf-8", "replace")))
        low = 1
        for width in WIDTHS:
            some = [x for x in left if low < len(x[1]) <= width]
            low = width
            for i in range(0, len(some), ABREAST):
                part = some[i : i + ABREAST]
                self.memo.update(zip((w for w, _ in part), self._abreast([b for _, b in part], width)))

    def word(self, word: str) -> list[int]:
        parts = [self.first[b] for b in word.encode("utf-8", "replace")]
        if len(parts) < 2:
            return parts
        if len(parts) > LONG_WORD:
            return self._by_heap(parts)
        rank, made = self.rank.get, self.made
        ranks = [rank(a << 32 | b, _NEVER) for a, b in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == _NEVER:
                break
            at = ranks.index(low)
            parts[at] = made[low]
            del parts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = rank(parts[at] << 32 | parts[at + 1], _NEVER)
            if at:
                ranks[at - 1] = rank(parts[at - 1] << 32 | parts[at], _NEVER)
        return parts

    def _by_heap(self, parts: list[int]) -> list[int]:
        n = len(parts)
        before, after = [*range(-1, n - 1)], [*range(1, n + 1)]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := self.rank.get(parts[i] << 32 | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            low, at, a, b = heapq.heappop(heap)
            right = after[at]
            if right >= n or parts[at] != a or parts[right] != b:
                continue  # a part was merged meanwhile
            parts[at] = self.made[low]
            parts[right] = -1
            after[at] = after[right]
            if after[at] < n:
                before[after[at]] = at
            for i in (before[at], at):
                if i >= 0 and after[i] < n and (r := self.rank.get(parts[i] << 32 | parts[after[i]])) is not None:
                    heapq.heappush(heap, (r, i, parts[i], parts[after[i]]))
        return [p for p in parts if p >= 0]

    def encode(self, texts: list[str], memo: int = MEMO) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers. memo: words remembered, up to twice."""
        self.memo.turn(memo)
        get, out = self.memo.__getitem__, []
        cut = [[p if n % 2 else self.find(p) for n, p in enumerate(self.cut.split(t) if self.cut else [t])] for t in texts]
        self.learn(set(chain.from_iterable(p for pieces in cut for p in pieces[::2])))
        for pieces in cut:
            ids = []
            for n, piece in enumerate(pieces):
                if n % 2:
                    ids.append(_little([self.special[piece]]))
                else:
                    ids.extend(map(get, piece))
            out.append(b"".join(ids))
        return out

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


class _Memo(dict):
    """Packed ids of the words met lately: this generation of words, and the one before it."""

    def __init__(self, work):
        super().__init__()
        self.work = work
        self.old: dict[str, bytes] = {}

    def turn(self, most: int) -> None:
        if len(self) > most:
            self.old = dict(self)
            self.clear()

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word) or _little(self.work(word))
        if len(word) <= 64:
            self[word] = found
        return found


_loaded: dict[int, Bpe] = {}


def _bpe(shared) -> Bpe:
    """The vocabulary of this worker, built once."""
    key = hash(shared.value)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Bpe(shared.value)
    return _loaded[key]


def load(spark: SparkSession, path: str):
    """The vocabulary file as a broadcast variable. path: on the driver."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _little(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _map(df: DataFrame, source: str, added: list[tuple[str, str]], work, drop: bool = False) -> DataFrame:
    """Append columns made from one column, batch by batch. drop: leave the one column out."""
    common.tune(df.sparkSession)
    taken = {c for c, _ in added}
    df = df.select(*[f"`{c}`" for c in df.columns if c not in taken or c == source])
    at = df.columns.index(source)
    kept = [n for n in range(len(df.columns)) if n != at or not drop]

    def run(batches):
        for batch in batches:
            columns = work(batch.column(at))
            yield pa.record_batch([*(batch.column(n) for n in kept), *columns], names=[*(batch.schema.names[n] for n in kept), *(c for c, _ in added)])

    schema = [f"`{df.schema[n].name}` {df.schema[n].dataType.simpleString()}" for n in kept] + [f"`{c}` {kind}" for c, kind in added]
    return df.mapInArrow(run, ", ".join(schema))


def _encoded(bpe: Bpe, texts: pa.Array, memo: int) -> list[pa.Array]:
    rows = [t.decode("utf-8", "replace") for t in common.byte_rows(texts)]
    ids = [i for n in range(0, len(rows), TEXTS) for i in bpe.encode(rows[n : n + TEXTS], memo)]
    return [pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())]


def _decoded(bpe: Bpe, ids: pa.Array) -> pa.Array:
    return pa.array([bpe.decode(np.frombuffer(raw or b"", "<u4").tolist()) for raw in ids.to_pylist()], pa.string())


def encode(df: DataFrame, vocabulary, column: str = "text", memo: int = MEMO) -> DataFrame:
    """Append ids (binary: little-endian unsigned 32-bit integers) and n_tokens. vocabulary: from load(); memo: words a worker remembers, up to twice."""
    return _map(df, column, ENCODED, lambda texts: _encoded(_bpe(vocabulary), texts, memo))


def decode(df: DataFrame, vocabulary, column: str = "ids") -> DataFrame:
    """Append decoded, the text of the ids with special tokens written out."""
    return _map(df, column, DECODED, lambda ids: [_decoded(_bpe(vocabulary), ids)])


def round_trip(df: DataFrame, vocabulary, column: str = "text", drop: bool = False, memo: int = MEMO) -> DataFrame:
    """Append ids, n_tokens and decoded, as encode() and then decode() do, in one worker a task instead of two. drop: leave the text out."""

    def work(texts: pa.Array) -> list[pa.Array]:
        bpe = _bpe(vocabulary)
        columns = _encoded(bpe, texts, memo)
        return [*columns, _decoded(bpe, columns[0])]

    return _map(df, column, ENCODED + DECODED, work, drop)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    vocabulary = load(spark, path or default_path())
    docs = common.read(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, vocabulary, drop=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )
