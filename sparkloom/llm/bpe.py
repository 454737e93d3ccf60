"""BPE encoding and decoding in batched numpy merge rounds.

Texts are cut at ASCII white space into chunks, which no token spans. Chunks that a worker hasn't met lately
are normalised, cut into pieces, and all their pieces are merged together: the symbols of all pieces stand in
one flat array, each round finds every neighbouring pair's rank by binary search in the sorted pair keys, and
merges each piece's lowest-ranked pair wherever it occurs.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import batches, map_arrow, text_bytes, word_offsets

#: Chunks that one worker remembers, and the longest chunk that it remembers: together some 200 MB.
REMEMBERED, LONGEST = 800_000, 4096
#: Symbols of a piece from which its rounds look only at blocks of pairs that hold the lowest rank.
LONG_PIECE = 2048
#: Neighbouring pairs in such a block.
BLOCK = 256
NO_RANK = np.int64(1) << 40


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


#: fixed values: the parts of a tokenizer file on which cutting at white space and merging here rely
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
SPLIT = {"type": "Split", "pattern": {"Regex": PIECES}, "behavior": "Removed", "invert": True}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
PLAIN = {"dropout": None, "continuing_subword_prefix": None, "byte_fallback": False, "ignore_merges": False}


def check_cuts(spec: dict) -> None:
    """Refuses a tokenizer file whose texts can't be cut at ASCII white space and encoded apart."""
    cuts = spec["normalizer"] == {"type": "Sequence", "normalizers": NORMALIZER} and spec["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [SPLIT, BYTES]}
    tokens = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] or any(c.isspace() for c in t["content"])) for t in spec["added_tokens"])
    if not cuts or not tokens:
        raise ValueError("the tokenizer file's normalizer, pre-tokenizer or added tokens are not those that this operator knows")


class Vocabulary:
    """Merge tables of a byte-level BPE vocabulary with word ends, from the JSON of its tokenizer file."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        check_cuts(spec)
        if spec["model"]["type"] != "BPE" or any(spec["model"].get(k) != v for k, v in PLAIN.items()) or spec["decoder"] is not None:
            raise ValueError("the tokenizer file's model or decoder is not one that this operator knows")
        model, vocab = spec["model"], spec["model"]["vocab"]
        end = model.get("end_of_word_suffix") or ""
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.final = np.array([vocab[s + end] for s in symbols], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged[order]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.special_re = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None
        self.piece_re = regex.compile(PIECES.replace(r"\s", r"\p{White_Space}"))
        names = {i: s for s, i in vocab.items()} | {i: s for s, i in special.items()}
        self.tokens = [names.get(i, "").encode() for i in range(max(names) + 1)]

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of pairs in the sorted keys; -1 where there is no such merge."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, at, -1)

    def merge(self, symbols: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges of many words at once: symbols of all words in one array, and the words' lengths, all above 0."""
        done_symbols, done_words = [], []
        out_lens = lens.copy()
        word = np.repeat(np.arange(len(lens)), lens)
        while len(symbols):
            inside = word[1:] == word[:-1]
            at = np.full(len(symbols), -1)
            at[:-1][inside] = self.lookup(symbols[:-1][inside], symbols[1:][inside])
            rank = np.where(at >= 0, self.ranks[at], NO_RANK)
            starts = np.flatnonzero(np.append(True, ~inside))
            low = np.minimum.reduceat(rank, starts)
            of_word = np.repeat(low, np.diff(np.append(starts, len(symbols))))
            live = of_word < NO_RANK
            if not live.all():
                done_symbols.append(symbols[~live])
                done_words.append(word[~live])
                symbols, word, rank, of_word, at = symbols[live], word[live], rank[live], of_word[live], at[live]
            hit = rank == of_word
            # Of neighbouring hits (a pair of equal symbols), the first, third, ... merge.
            where = np.flatnonzero(hit)
            if len(where) > 1:
                run = np.cumsum(np.append(True, np.diff(where) != 1))
                head = where[np.searchsorted(run, run)]
                where = where[(where - head) % 2 == 0]
            symbols[where] = self.merged[at[where]]
            keep = np.ones(len(symbols), bool)
            keep[where + 1] = False
            np.subtract.at(out_lens, word[where], 1)
            symbols, word = symbols[keep], word[keep]
        if not done_symbols:
            return symbols, out_lens
        flat, owner = np.concatenate(done_symbols), np.concatenate(done_words)
        return flat[np.argsort(owner, kind="stable")], out_lens

    def merge_long(self, symbols: np.ndarray) -> np.ndarray:
        """The same rounds for one long word: the lowest rank of each block of places is kept, so that a round finds the
        lowest of all among the blocks' and goes only over blocks that have it, and over the neighbours of what it merges.
        """
        n = len(symbols)
        size = -(-n // BLOCK) * BLOCK
        symbols = symbols.copy()
        after, before = np.append(np.arange(1, n), -1), np.arange(-1, n - 1)  # -1: none
        rank, merged = np.full(size, NO_RANK), np.zeros(size, np.int64)

        def look(left: np.ndarray) -> None:
            """Looks up the pairs that start at these places anew; places at the end have none."""
            right = after[left]
            at = np.where(right >= 0, self.lookup(symbols[left], symbols[right]), -1)
            rank[left] = np.where(at >= 0, self.ranks[at], NO_RANK)
            merged[left] = self.merged[at]

        look(np.arange(n))
        blocks = rank.reshape(-1, BLOCK)
        lowest = blocks.min(axis=1)
        while (low := lowest.min()) < NO_RANK:
            at = np.flatnonzero(lowest == low)
            row, place = np.nonzero(blocks[at] == low)
            where = at[row] * BLOCK + place  # ascending
            # Of overlapping hits (pairs of equal symbols in a row), the first, third, ... merge.
            if len(where) > 1:
                run = np.cumsum(np.append(True, after[where[:-1]] != where[1:]))
                where = where[(np.arange(len(where)) - np.searchsorted(run, run)) % 2 == 0]
            gone = after[where]
            symbols[where] = merged[where]
            symbols[gone], rank[gone] = -1, NO_RANK
            after[where] = after[gone]
            has = after[where] >= 0
            before[after[where][has]] = where[has]
            left = before[where]
            touched = np.concatenate([where, left[left >= 0]])
            look(touched)
            stale = np.unique(np.concatenate([touched, gone]) // BLOCK)
            lowest[stale] = blocks[stale].min(axis=1)
        return symbols[symbols >= 0]

    def pieces(self, chunk: str) -> list[tuple[bytes, int]]:
        """Pieces of a chunk, each with -1 or, for a special token, its id."""
        out: list[tuple[bytes, int]] = []
        for k, part in enumerate(self.special_re.split(chunk)) if self.special_re and "<" in chunk else ((0, chunk),):
            if k % 2:
                out.append((b"!", self.special[part]))
                continue
            part = unicodedata.normalize("NFC", part)
            part = "".join(x.lower() for x in part) if "Σ" in part else part.lower()  # no final sigma
            out += [(p.encode(), -1) for p in self.piece_re.findall(part)]
        return out

    def chunks(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks without ASCII white space: all in one array, and how many each chunk has."""
        pieces: list[bytes] = []
        counts, given = np.ones(len(new), np.int64), {}
        for i, c in enumerate(new):
            if c.isalpha():  # ASCII letters only: one piece
                pieces.append(c.lower())
                continue
            mine = self.pieces(c.decode())
            counts[i] = len(mine)
            for p, special in mine:
                if special >= 0:
                    given[len(pieces)] = special
                pieces.append(p)
        lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(lens)
        long = {i: self.merge_long(self.symbols(pieces[i])) for i in np.flatnonzero(lens >= LONG_PIECE).tolist()}
        for i in long:
            pieces[i] = b"!"
        if long:
            lens[list(long)] = 1
            ends = np.cumsum(lens)
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        symbols = self.inner[raw]
        symbols[ends - 1] = self.final[raw[ends - 1]]
        flat, n = self.merge(symbols, lens)
        at = np.append(0, np.cumsum(n))
        for i, special in given.items():
            flat[at[i]] = special
        if long:
            flat = np.concatenate([long[i] if i in long else flat[at[i] : at[i + 1]] for i in range(len(pieces))])
            for i, ids in long.items():
                n[i] = len(ids)
            at = np.append(0, np.cumsum(n))
        return flat, np.diff(at[np.append(0, np.cumsum(counts))])

    def symbols(self, piece: bytes) -> np.ndarray:
        raw = np.frombuffer(piece, np.uint8)
        return np.append(self.inner[raw[:-1]], self.final[raw[-1]])

    def decode(self, ids: np.ndarray) -> bytes:
        """Tokens joined by a space, as the library joins them when a tokenizer has no decoder."""
        t = self.tokens
        return b" ".join([t[i] for i in ids.tolist()])


class Places(dict):
    """Numbers chunks as they are first met."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        self[chunk] = n = len(self)
        self.new.append(chunk)
        return n


class Encoder:
    """Encodes batches of texts and remembers a bounded number of chunks.

    ``chunk_ids`` encodes new chunks: it returns all their ids in one array, and how many each has.
    """

    def __init__(self, chunk_ids: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]) -> None:
        self.chunk_ids = chunk_ids
        self.forget()

    def forget(self) -> None:
        self.places = Places()
        self.flat = np.zeros(1 << 20, np.uint32)
        self.ends = np.zeros(1 << 16, np.int64)  # ends[i + 1]: end of chunk i in flat

    def __call__(self, raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and n + 1 offsets."""
        data = raw.tobytes()
        words = b"\n".join([data[i:j] for i, j in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]).split()
        if len(self.places) > REMEMBERED:
            self.forget()
        k = len(self.places)
        at = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        if new := self.places.new:
            ids, lens = self.chunk_ids(new)
            used = int(self.ends[k])
            while used + len(ids) > len(self.flat):
                self.flat = np.append(self.flat, np.zeros_like(self.flat))
            while k + len(new) >= len(self.ends):
                self.ends = np.append(self.ends, np.zeros_like(self.ends))
            self.flat[used : used + len(ids)] = ids
            self.ends[k + 1 : k + 1 + len(new)] = used + np.cumsum(lens)
            self.places.new = []
        starts = self.ends[at]
        lens = self.ends[at + 1] - starts
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        out = self.flat[np.arange(total) + np.repeat(starts - (ends - lens), lens)]
        bounds = np.append(0, ends)[word_offsets(raw, offs)]
        if new and max(map(len, new)) > LONGEST:
            self.forget()  # a few very long chunks would hold as much memory as all others
        return out, bounds


@functools.lru_cache(1)
def vocabulary(text: str) -> Vocabulary:
    return Vocabulary(text)


_ENCODERS: dict[str, Encoder] = {}


def encoder(text: str) -> Encoder:
    """The worker's own encoder for a tokenizer file, kept between tasks."""
    if text not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[text] = Encoder(vocabulary(text).chunks)
    return _ENCODERS[text]


def read_vocabulary(df: DataFrame, path: str):  # noqa: ANN201
    """The tokenizer file's text as a broadcast variable: read by the driver, a few MB whatever the corpus."""
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def with_columns(df: DataFrame, column: str, fields: list[T.StructField], make: Callable[[np.ndarray, np.ndarray], list[pa.Array]], source: str | None = None) -> DataFrame:
    """``df`` with more columns from ``make``(bytes of all texts, offsets), replacing columns of the same name."""
    names = {f.name for f in fields}
    kept = [c for c in df.columns if c not in names]
    schema = T.StructType([*(df.schema[c] for c in kept), *fields])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it, column):
            new = make(*text_bytes(batch.column(column)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *new], names=[*kept, *(f.name for f in fields)])

    return map_arrow(df, run, schema)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column ``ids`` (array of int), no special tokens added.

    Null and empty texts have an empty array. The strings of special tokens in a text become their ids, as in the
    library. Repeated rows and an empty table come back as they are; an existing column ``ids`` is replaced; other
    columns are kept whatever their names. Texts of any length are encoded whole.
    """
    shared = read_vocabulary(docs, path)

    def make(raw: np.ndarray, offs: np.ndarray) -> list[pa.Array]:
        flat, bounds = encoder(shared.value)(raw, offs)
        return [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.astype(np.int32)))]

    return with_columns(docs, text, [T.StructField(ids, T.ArrayType(T.IntegerType()))], make)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with a column ``text``: tokens of ``ids`` joined by a space; empty for null and empty arrays.

    Special tokens are kept as text. An id without a token gives an empty string in its place.
    """
    shared = read_vocabulary(df, path)
    kept = [c for c in df.columns if c != text]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(text, T.StringType())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            v = vocabulary(shared.value)
            new = [v.decode(np.array(x or [], np.int64)).decode() for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(new, pa.string())], names=[*kept, text])

    return map_arrow(df, run, schema)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): every text encoded, its ids decoded again, and digests of both.

    Ids and decoded texts stay in the task that makes them. Nulls and empty texts have no ids and decode to an empty
    string; every row, repeated or not, gives a row.
    """
    shared = read_vocabulary(docs, path)
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]

    def make(raw: np.ndarray, offs: np.ndarray) -> list[pa.Array]:
        flat, bounds = encoder(shared.value)(raw, offs)
        v, n = vocabulary(shared.value), len(bounds) - 1
        flat = flat.astype("<u4")
        of = [flat[bounds[i] : bounds[i + 1]] for i in range(n)]
        return [
            pa.array(np.diff(bounds), pa.int64()),
            pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in of]),
            pa.array([hashlib.sha256(v.decode(x)).hexdigest() for x in of]),
        ]

    return with_columns(docs.select(key, text), text, fields, make).drop(text)
