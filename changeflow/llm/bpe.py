"""Byte-level BPE: encoding by a lazily determinised transducer, decoding by an incremental UTF-8 machine.

A merge list fixes, for every byte string, one sequence of tokens, and a sequence is that one exactly if each pair of
neighbours is what the two alone would be merged to (``fits``). So the last token of every prefix of a word is the one
token that ends there and agrees with the last token of the prefix before it. ``Transducer`` reads a byte at a time: its
state is the longest end of the input that begins a token, with the longest token that ends there as output; shorter ones
follow by links until one agrees. States, moves and links are made when they are first needed and kept; there are no more
states than distinct beginnings of tokens. Inside a word longer than ``settle_at`` bytes, tokens are emitted as soon as
every boundary from which a longer token could still start lies on the same path: one longest token of lookahead is
enough to tell.

Words are cut by the given pattern, as the published encoders do; a word's ids are kept in a bounded table so that the
transducer runs for new words only. ``Utf8`` decodes token bytes as they come and holds back incomplete characters.

Edge cases: null text is empty (no tokens, digests of the empty string); a word of any length takes linear time;
strings of special tokens are ordinary text; repeated rows are encoded each; an empty table gives no rows; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Transducer:
    def __init__(self, ranks: dict[bytes, int], settle_at: int = 1 << 10, keep_pairs: int = 1 << 19):
        self.ranks, self.settle_at, self.keep_pairs = ranks, settle_at, keep_pairs
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.length = {i: len(b) for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.begins = {b[:i] for b in ranks for i in range(1, len(b) + 1)}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.links: dict[int, int] = {}
        self.pairs: dict[int, bool] = {}
        self.ids, self.texts = {b"": 0}, [b""]
        self.moves: list[dict[int, int]] = [{}]
        self.outputs: list[int] = [-1]

    def merged(self, text: bytes, least: int = 1) -> list[int]:
        """Tokens of a short byte string by the merge list itself, or its last ``least`` parts before they are merged."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > least:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for single bytes and for tokens that no merge makes."""
        if token not in self.halves:
            parts = self.merged(self.bytes_of[token], 2)
            self.halves[token] = tuple(parts) if len(parts) == 2 else None
        return self.halves[token]

    def made(self, token: int) -> bool:
        return self.length[token] == 1 or self.split(token) is not None

    def fits(self, a: int, b: int) -> bool:
        """Whether a and b stay apart when their bytes are merged together.

        Merges are undone, the latest first. What then touches at the boundary must not have a merge that would have
        come before the one undone; of equal merges the left one comes first.
        """
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            known, before, x, y = True, 1 << 60, a, b
            while True:
                across = self.ranks.get(self.bytes_of[x] + self.bytes_of[y])
                if across is not None and across < before:
                    known = False
                    break
                left, right = self.split(x), self.split(y)
                if left and (x > y or not right):
                    before, x = x, left[1]
                elif right:
                    before, y = y + 1, right[0]
                else:
                    break
            if len(self.pairs) >= self.keep_pairs:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def longest_end(self, text: bytes) -> int:
        """The longest token made by merges that ends a byte string."""
        return next(t for i in range(len(text)) if (t := self.ranks.get(text[i:])) is not None and self.made(t))

    def link(self, token: int) -> int:
        """The next shorter token that ends where this one ends."""
        if (t := self.links.get(token)) is None:
            t = self.links[token] = self.longest_end(self.bytes_of[token][1:])
        return t

    def move(self, state: int, byte: int) -> int:
        text = self.texts[state] + bytes((byte,))
        while text not in self.begins:
            text = text[1:]
        if (to := self.ids.get(text)) is None:
            to = self.ids[text] = len(self.texts)
            self.texts.append(text)
            self.moves.append({})
            self.outputs.append(self.longest_end(text))
        self.moves[state][byte] = to
        return to

    def path(self, lasts: list[int], end: int) -> list[int]:
        """Tokens from the first open byte to a boundary, in order."""
        out = []
        while end > 0:
            out.append(lasts[end - 1])
            end -= self.length[out[-1]]
        return out[::-1]

    def settled(self, text: bytes, lasts: list[int]) -> list[int]:
        """Tokens that no further byte can change: the common start of the paths to all live boundaries."""
        n = len(text)
        live = [n, *(j for j in range(max(1, n - self.longest + 1), n) if text[j:] in self.begins)]
        done = []
        for tokens in zip(*(self.path(lasts, j) for j in live), strict=False):
            if len(set(tokens)) > 1:
                break
            done.append(tokens[0])
        return done

    def encode(self, word: bytes) -> list[int]:
        if (whole := self.ranks.get(word)) is not None:
            return [whole]
        out: list[int] = []
        moves, outputs, length, pairs = self.moves, self.outputs, self.length, self.pairs
        lasts, state, n, open_from, before = [], 0, 0, 0, None
        for at, byte in enumerate(word, 1):
            to = moves[state].get(byte)
            state = self.move(state, byte) if to is None else to
            token, n = outputs[state], n + 1
            while True:
                k = n - length[token]
                last = lasts[k - 1] if k > 0 else before if k == 0 else -1
                if last is None:
                    break
                if last >= 0:
                    fit = pairs.get(last << 32 | token)
                    if self.fits(last, token) if fit is None else fit:
                        break
                token = self.link(token)
            lasts.append(token)
            if n >= self.settle_at and n % self.longest == 0 and (done := self.settled(word[open_from:at], lasts)):
                out += done
                shift = sum(length[t] for t in done)
                before, open_from, n = done[-1], open_from + shift, n - shift
                del lasts[:shift]
        return out + self.path(lasts, n)


class Utf8:
    """Incremental decoder: feed bytes, get characters; bytes of an unfinished character stay inside.

    States are the number of bytes to come and the range allowed for the next; malformed input gives U+FFFD.
    """

    def __init__(self) -> None:
        self.held, self.need, self.low, self.high = bytearray(), 0, 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        if not self.need:
            try:
                return data.decode()
            except UnicodeDecodeError:
                pass
        out = []
        for b in data:
            if self.need and self.low <= b <= self.high:
                self.held.append(b)
                self.need, self.low, self.high = self.need - 1, 0x80, 0xBF
                if not self.need:
                    out.append(self.held.decode())
                    self.held.clear()
                continue
            if self.need:
                out.append("�")
                self.held.clear()
                self.need, self.low, self.high = 0, 0x80, 0xBF
            if b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b <= 0xF4:
                self.need = 1 if b < 0xE0 else 2 if b < 0xF0 else 3
                self.low = {0xE0: 0xA0, 0xF0: 0x90}.get(b, 0x80)
                self.high = {0xED: 0x9F, 0xF4: 0x8F}.get(b, 0xBF)
                self.held.append(b)
            else:
                out.append("�")
        return "".join(out)

    def end(self) -> str:
        left, self.need = bool(self.held), 0
        self.held.clear()
        return "�" if left else ""


class Codec:
    """Ids are little-endian unsigned 32-bit integers in bytes. keep_words bounds the table of words already encoded."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, keep_words: int = 1 << 18):
        self.machine, self.cut, self.keep = Transducer(ranks), regex.compile(pattern), keep_words
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        words = self.cut.findall(text)
        parts = list(map(self.known.get, words))
        if None in parts:
            for i, ids in enumerate(parts):
                if ids is None:
                    word = words[i]
                    if (ids := self.known.get(word)) is None:
                        tokens = self.machine.encode(word.encode())
                        ids = struct.pack(f"<{len(tokens)}I", *tokens)
                        if len(word) <= 64:
                            if len(self.known) >= self.keep:
                                self.known.clear()
                            self.known[word] = ids
                    parts[i] = ids
        return b"".join(parts)

    def token_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.machine.bytes_of.__getitem__, ids))

    def decode(self, ids: bytes, at_once: int = 1 << 14) -> Iterator[str]:
        """Text in pieces, from windows of ids."""
        utf8 = Utf8()
        for i in range(0, len(ids), 4 * at_once):
            part = ids[i : i + 4 * at_once]
            yield utf8.feed(self.token_bytes(struct.unpack(f"<{len(part) // 4}I", part)))
        yield utf8.end()


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec for a Python worker; ``path`` is local or the name of a file added to the session."""
    if (path, pattern) not in _codecs:
        try:
            ranks = load_ranks(path)
        except FileNotFoundError:
            ranks = load_ranks(SparkFiles.get(path.rsplit("/", 1)[-1]))
        _codecs[path, pattern] = Codec(ranks, pattern)
    return _codecs[path, pattern]


def encode_documents(spark: SparkSession, docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (little-endian 32-bit ids), decoded_sha256 (bytes of the decoded text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = own.encode(text.as_py() or "")
                back = hashlib.sha256()
                for piece in own.decode(ids):
                    back.update(piece.encode())
                rows.append((doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), back.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema) if rows else pa.RecordBatch.from_pylist([], schema)

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInArrow(task, SCHEMA)
