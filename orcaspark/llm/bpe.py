"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece exactly one token can end its encoding. ``PrefixTable``
keeps that token per prefix: the token ``t`` ending at ``e`` is the one whose predecessor,
the last token of the prefix it starts at, would not have merged with it or with a part of
it. The table of a text never changes when bytes are appended, and after an edit it is
equal to the old one as soon as as many entries agree as the longest token has bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
import string
from functools import lru_cache
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from orcaspark.llm.common import per_batch, table, texts

#: A space before anything but white space always begins a piece of the pattern below.
BOUNDARY = re.compile(r" (?=\S)")
UNEVEN = re.compile(r" (?:\s|$)")
#: Characters that a match of the pattern may look at behind its end.
LOOKAHEAD = 3
#: Signs that mostly end a word, alone or several of them.
ENDS = string.punctuation.replace("'", "")
#: Entries of a worker's caches: encoded words of either generation, seams and ends of words, which start anew when full.
WORDS, SEAMS, TAILS = 200_000, 400_000, 10_000


class Codec:
    """Encoder and decoder of one rank file.

    ``ranks`` maps token bytes to ids; all 256 single bytes must be tokens. ``pattern``
    splits a text into pieces that are encoded separately.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.size = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.never = max(self.bytes_of) + 1
        self._halves: dict[int, tuple[int, int] | None] = {}
        # By token: whether it fits behind the tokens tried so far.
        self._seams: dict[int, dict[int, bool]] = {rank: {} for rank in self.bytes_of}
        self._tried = 0
        # Finds, at every byte, the tokens that end there, longest first (bytes as Latin-1 text), with their seams.
        self.finder = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.finder.add_word(token.decode("latin-1"), (rank, len(token), self._seams[rank]))
        self.finder.make_automaton()

    @classmethod
    def from_file(cls, path: str, pattern: str) -> Codec:
        lines = Path(path).read_bytes().split(b"\n")
        pairs = (line.split() for line in lines if line)
        return cls({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; itself twice if one byte, None if no merge does."""
        if token not in self._halves:
            parts = [self.ranks[bytes([b])] for b in self.bytes_of[token]]
            found = (token, token) if len(parts) == 1 else None
            while len(parts) > 1:
                merges = [self.merged(a, b) for a, b in zip(parts, parts[1:], strict=False)]
                first = min((m for m in merges if m is not None), default=None)
                if first is None:
                    break
                if len(parts) == 2:
                    found = (parts[0], parts[1])
                place = merges.index(first)
                parts[place : place + 2] = [first]
            self._halves[token] = found
        return self._halves[token]

    def merged(self, left: int, right: int) -> int | None:
        return self.ranks.get(self.bytes_of[left] + self.bytes_of[right])

    def fits(self, left: int, right: int) -> bool:
        """Whether the encoding of both tokens' bytes together is just these two tokens.

        Undoes merges at the seam, latest first. A pair at the seam stays apart if the
        merge that would join it comes after the one that takes either part away.
        ``left`` is -1 where nothing precedes.
        """
        if self._tried > SEAMS:
            for seams in self._seams.values():
                seams.clear()
            self._tried = 0
        holds = self.halves(right) is not None and (left < 0 or self._seam_holds(left, right))
        self._seams[right][left] = holds
        self._tried += 1
        return holds

    def _seam_holds(self, left: int, right: int) -> bool:
        taken = self.never
        while True:
            joined = self.merged(left, right)
            if joined is not None and joined < taken:
                return False
            made_left = left if len(self.bytes_of[left]) > 1 else -1
            made_right = right if len(self.bytes_of[right]) > 1 else -1
            if made_left == made_right == -1:
                return True
            if made_left > made_right:
                taken, left = made_left, self.halves(left)[1]
            else:  # at equal rank the merge further left comes first
                taken, right = made_right + 1, self.halves(right)[0]

    def extend(self, last: list[int], data: bytes, begin: int = 0) -> None:
        """Append to ``last`` (entry 0 is -1) the last token of every prefix of ``data`` beyond ``begin`` bytes."""
        fits = self.fits
        back = max(0, begin + 1 - self.longest)
        done = begin
        for end, (token, size, seams) in self.finder.iter(data[back:].decode("latin-1")):
            end += back + 1
            if end > done:
                left = last[end - size]
                holds = seams.get(left)
                if holds or (holds is None and fits(left, token)):
                    last.append(token)
                    done = end

    def walk(self, last: list[int]) -> list[int]:
        """Ids of the longest prefix in a table of last tokens."""
        ids, end, size = [], len(last) - 1, self.size
        while end:
            token = last[end]
            ids.append(token)
            end -= size[token]
        ids.reverse()
        return ids

    def encode_piece(self, piece: bytes) -> list[int]:
        token = self.ranks.get(piece)
        if token is not None:
            return [token]
        last = [-1]
        self.extend(last, piece)
        return self.walk(last)

    def encode(self, text: str) -> list[int]:
        return [t for piece in self.pattern.findall(text) for t in self.encode_piece(piece.encode())]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class PrefixTable:
    """Last token of every byte prefix of one piece, in order of length."""

    def __init__(self, codec: Codec, data: bytes = b""):
        self.codec = codec
        self.data = b""
        self.last = [-1]
        self.append(data)

    def append(self, data: bytes) -> None:
        """Lengthen the piece; entries so far stay as they are."""
        begin = len(self.data)
        self.data += data
        self.codec.extend(self.last, self.data, begin)

    def replace(self, start: int, stop: int, data: bytes) -> int:
        """Put ``data`` for the bytes from ``start`` to ``stop``; returns the entries computed."""
        old, shift, longest = self.last, len(data) - (stop - start), self.codec.longest
        self.data = self.data[:start] + data + self.data[stop:]
        self.last = old[: start + 1]
        settled = start + len(data)
        end = start
        while end < len(self.data):
            begin, end = end, min(max(end, settled) + longest, len(self.data))
            self.codec.extend(self.last, self.data[:end], begin)
            if end - settled >= longest and self.last[end + 1 - longest :] == old[end + 1 - longest - shift : end + 1 - shift]:
                self.last += old[end + 1 - shift :]
                break
        return end - start

    def tokens(self) -> list[int]:
        """Ids of the whole piece (a whole-piece token is chosen by ``Codec.encode_piece``)."""
        return self.codec.walk(self.last)


class EncodedText:
    """A text with its pieces' ids, kept right under appends and edits near their place."""

    def __init__(self, codec: Codec, text: str = ""):
        self.codec = codec
        self.text = ""
        self.starts: list[int] = []
        self.ids: list[list[int]] = []
        self.replace(0, 0, text)

    def append(self, text: str) -> int:
        return self.replace(len(self.text), len(self.text), text)

    def replace(self, start: int, stop: int, text: str) -> int:
        """Edit characters; returns how many pieces were encoded anew."""
        ends = [*self.starts[1:], len(self.text)] if self.starts else []
        keep = 0
        while keep < len(ends) and ends[keep] + LOOKAHEAD <= start:
            keep += 1
        shift = len(text) - (stop - start)
        follow = {s + shift: i for i, s in enumerate(self.starts) if s >= stop}
        self.text = self.text[:start] + text + self.text[stop:]
        place = ends[keep - 1] if keep else 0
        starts, ids, rest = self.starts[:keep], self.ids[:keep], len(self.starts)
        done = 0
        for match in self.codec.pattern.finditer(self.text, place):
            if match.start() in follow:  # what a match takes depends on what follows only
                rest = follow[match.start()]
                break
            starts.append(match.start())
            ids.append(self.codec.encode_piece(match.group().encode()))
            done += 1
        self.starts = starts + [s + shift for s in self.starts[rest:]]
        self.ids = ids + self.ids[rest:]
        return done

    def tokens(self) -> list[int]:
        return [t for piece in self.ids for t in piece]


class _Words(dict):
    """Ids, as text, of words that follow a space; encodes what it doesn't hold.

    When full, the words become the older generation and the one before is dropped; a word
    that is met again is taken over, so frequent words stay.
    """

    def __init__(self, codec: Codec):
        super().__init__()
        self.older: dict[str, str] = {}
        self.codec = codec
        self.text = {token: str(token) for token in codec.bytes_of}
        self.tails: dict[str, str] = {}
        # Words of letters, with or without signs behind them, need no pattern if it says so.
        self.letters_are_pieces = all(
            "".join(found := codec.pattern.findall(f" {word}{end}")) == f" {word}{end}" and found[0] == f" {word}"
            for word in ("s", "Wörter", "中ª")
            for end in ("", *ENDS, *(a + b for a in ENDS for b in ENDS))
        )

    def piece(self, piece: str) -> str:
        return " ".join([self.text[token] for token in self.codec.encode_piece(piece.encode())])

    def ids(self, text: str) -> str:
        return " ".join(map(self.piece, self.codec.pattern.findall(text)))

    def __missing__(self, word: str) -> str:
        if len(self) >= WORDS:
            self.older = dict(self)
            self.clear()
        found = self.older.get(word)
        if found is None:
            found = self._encoded(word)
        self[word] = found
        return found

    def _encoded(self, word: str) -> str:
        if self.letters_are_pieces and word.isalpha():
            return self.piece(" " + word)
        letters = word.rstrip(ENDS)
        if self.letters_are_pieces and letters.isalpha():
            return f"{self[letters]} {self.tail(word[len(letters):])}"
        return self.ids(" " + word)

    def tail(self, signs: str) -> str:
        """Ids of the signs behind a word: what a piece takes depends on what follows only."""
        found = self.tails.get(signs)
        if found is None:
            if len(self.tails) >= TAILS:
                self.tails.clear()
            found = self.tails[signs] = self.ids(signs)
        return found


class CorpusEncoder:
    """Whole texts to ids written as decimal text, and back, with a worker's bounded caches."""

    def __init__(self, codec: Codec):
        self.words = _Words(codec)
        self.bytes_of = {str(i): token for i, token in codec.bytes_of.items()}

    def encode(self, text: str) -> str:
        if UNEVEN.search(text):
            first, *words = BOUNDARY.split(text)
        else:
            first, *words = text.split(" ")
        ids = list(map(self.words.__getitem__, words))
        return " ".join([self.words.ids(first), *ids] if first else ids)

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.split(" "))) if ids else b""


@lru_cache(maxsize=2)
def corpus_encoder(path: str, pattern: str) -> CorpusEncoder:
    return CorpusEncoder(Codec.from_file(path, pattern))


SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def tokenize(docs: DataFrame, path: str, pattern: str, *, with_ids: bool = False) -> DataFrame:
    """Encode and decode ``text`` of every row; one task per input split, no shuffle.

    Returns ``doc_id`` as it is (null and repeated ids too), the token count, SHA-256 of
    the ids written in decimal and joined by a space, SHA-256 of the decoded bytes, and
    with ``with_ids`` the ids themselves. Null and empty texts have no tokens. Other
    columns of the input are not read. ``path`` is a rank file on every executor.
    """

    def convert(batch: pa.RecordBatch) -> dict:
        encoder = corpus_encoder(path, pattern)
        counts, ids_hashes, text_hashes, lists = [], [], [], []
        for text in texts(batch["text"]):
            ids = encoder.encode(text)
            counts.append(ids.count(" ") + 1 if ids else 0)
            ids_hashes.append(hashlib.sha256(ids.encode()).hexdigest())
            text_hashes.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            if with_ids:
                lists.append(np.array(ids.split(" ") if ids else [], dtype=np.int32))
        out = {
            "doc_id": batch["doc_id"],
            "n_tokens": pa.array(counts, pa.int64()),
            "ids_sha256": pa.array(ids_hashes, pa.string()),
            "decoded_sha256": pa.array(text_hashes, pa.string()),
        }
        return out | ({"ids": pa.array(lists, pa.list_(pa.int32()))} if with_ids else {})

    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    return per_batch(docs.select("doc_id", "text"), convert, schema)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of all documents with the public 50k ranks."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return tokenize(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
