"""SentencePiece models of the merge type (BPE): exact encoding by backtracking, and decoding.

Such a model merges the best-scored neighbours first, the leftmost of equal ones, until none can be merged. The result
is the one row of pieces in which no two neighbours would have been merged across their boundary. It is found from
left to right: the longest piece that starts at a place is taken if it stands beside the piece before it, else the next
shorter one that is its prefix; where none stands, the piece before is given up. A bit for each place remembers that
nothing can begin there, so no place is tried in vain twice.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import ahocorasick
import pandas as pd
import sentencepiece
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SPACE = "▁"
CACHED_PARTS = 300_000
#: What a normaliser that only marks spaces makes of texts that others would change.
_PROBES = ("", " ", "a", " a  b ", "é ﬁ Ａ ① \xa0 　 \t\n\r", "­​﻿", "\x00\x07")


def normalised(text: str) -> str:
    """The text as the model's pieces spell it: spaces marked, one more before the first character."""
    return (SPACE + text.replace(" ", SPACE)) if text else ""


class Pieces:
    """A model's pieces with the order of their merges, how they were merged, and which of their neighbours stand."""

    def __init__(self, texts: dict[int, str], scores: dict[int, float], byte_ids: dict[int, int], end_id: int, parts: dict | None = None):
        self.texts, self.byte_ids, self.end_id = texts, byte_ids, end_id
        self.ids = {t: i for i, t in texts.items()}
        #: Merges by falling score; pieces of one score are merged from left to right.
        levels = {s: k for k, s in enumerate(sorted({scores[i] for i, t in texts.items() if len(t) > 1}, reverse=True), 1)}
        self.rank = {i: levels[scores[i]] if len(t) > 1 else 0 for i, t in texts.items()}
        self._stand: dict[int, bool] = {}
        self._sizes = {i: len(t) for i, t in texts.items()}
        self.parts = parts if parts is not None else self._merged_parts()
        found = ahocorasick.Automaton()
        for i, t in texts.items():
            if len(t) == 1 or i in self.parts:
                found.add_word(t, (len(t), i))
        if len(found):
            found.make_automaton()
        self._found, self._whole = found, {t: i for t, i in self.ids.items() if len(t) == 1 or i in self.parts}
        self._shorter = {i: next((self._whole[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self._whole), None) for t, i in self._whole.items()}
        self._byte_of = {i: b for b, i in byte_ids.items()}
        #: Where no piece goes on after a marked space, a text can be cut before each run of them; and around line ends,
        #: where no piece has any.
        cut = not any(re.search(f"[^{SPACE}]{SPACE}", t) for t in texts.values())
        line = "" if any("\n" in t for t in texts.values()) else "\n"
        self.cut = re.compile(f"{SPACE}*[^{SPACE}{line}]+|{SPACE}+" + (f"|{line}+" if line else "") if cut else r"(?s:.+)").findall

    @staticmethod
    def load(path: str) -> Pieces:
        """The pieces of a model file. Models of another type than BPE with bytes for unknown characters, with a normaliser
        that changes texts, or with pieces of their own rules, are refused."""
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        if any(model.normalize(t) != normalised(t) for t in _PROBES):
            raise ValueError(f"{path}: the model's normaliser does more than to mark spaces")
        every = range(model.get_piece_size())
        byte_ids = {int(model.id_to_piece(i)[3:-1], 16): i for i in every if model.is_byte(i)}
        if len(byte_ids) != 256 or any(model.is_unused(i) for i in every):
            raise ValueError(f"{path}: the model has unused pieces, or no bytes for unknown characters")
        texts = {i: model.id_to_piece(i) for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
        return Pieces(texts, {i: model.get_score(i) for i in texts}, byte_ids, model.eos_id())

    def tables(self) -> tuple:
        """What another process makes the same pieces from."""
        return self.texts, {i: -float(r) for i, r in self.rank.items()}, self.byte_ids, self.end_id, self.parts

    def _merged_parts(self) -> dict[int, tuple[int, int]]:
        """The two pieces that each piece is merged from in the end, for those that merging ever makes."""
        self.parts = {}
        for i in sorted(self.texts, key=lambda i: (self.rank[i], len(self.texts[i]))):
            text, rank = self.texts[i], self.rank[i]
            for at in range(1, len(text)):
                left, right = self.ids.get(text[:at]), self.ids.get(text[at:])
                known = all(p is not None and (not self.rank[p] or p in self.parts and self.rank[p] <= rank) for p in (left, right))
                if known and self._stands(left, right, rank):
                    self.parts[i] = left, right
                    break
        return self.parts

    def _stands(self, left: int, right: int, limit: int) -> bool:
        """Whether merges of a rank below `limit` leave the boundary between two pieces standing. Both are taken apart
        again, the later merge first: what then meets at the boundary must not be a pair that was merged before."""
        texts, rank, parts = self.texts, self.rank, self.parts
        while True:
            across = self.ids.get(texts[left] + texts[right])
            if across is not None and rank[across] < limit:
                return False
            if left in parts and (right not in parts or rank[left] > rank[right]):
                limit, left = rank[left], parts[left][1]
            elif right in parts:  # of equal ranks the pair at the boundary is further left, so it came first
                limit, right = rank[right] + 1, parts[right][0]
            else:
                return True

    def stand(self, left: int, right: int) -> bool:
        if len(self._stand) > 1_000_000:
            self._stand.clear()
        known = self._stand[left << 32 | right] = self._stands(left, right, len(self.rank) + 1)
        return known

    def encode_part(self, text: str) -> list[int]:
        """The ids of normalised text. A character without a piece is its bytes, and nothing is merged across it."""
        whole = self._whole.get(text)
        if whole is not None:
            return [whole]
        longest: list[int | None] = [None] * len(text)
        for end, (n, i) in self._found.iter(text):  # of the pieces that start at a place the longest ends last
            longest[end + 1 - n] = i
        if None not in longest:
            return self._known(longest, 0, len(text))
        out, at = [], 0
        while at < len(text):
            if longest[at] is None:
                out += [self.byte_ids[b] for b in text[at].encode("utf-8")]
                at += 1
                continue
            stop = next((k for k in range(at, len(text)) if longest[k] is None), len(text))
            out += self._known(longest, at, stop)
            at = stop
        return out

    def _known(self, longest: list[int | None], start: int, stop: int) -> list[int]:
        """The pieces of the places from start to stop, whose characters all have pieces."""
        sizes, shorter, stand, out, failed = self._sizes, self._shorter, self._stand, [], None
        at, piece, last = start, longest[start], -1
        while at < stop:
            end = at + sizes[piece]
            if end <= stop and (failed is None or not failed[end - start >> 3] >> (end - start & 7) & 1):
                stands = last < 0 or stand.get(last << 32 | piece)
                if stands or stands is None and self.stand(last, piece):
                    out.append(piece)
                    at, last = end, piece
                    if end < stop:
                        piece = longest[end]
                    continue
            piece = shorter[piece]
            if piece is None:  # nothing that begins here stands beside the last piece, which is given up
                if failed is None:
                    failed = bytearray((stop - start >> 3) + 1)
                failed[at - start >> 3] |= 1 << (at - start & 7)
                piece = out.pop()
                at -= sizes[piece]
                last = out[-1] if out else -1
        return out

    def encode(self, text: str) -> list[int]:
        return [i for part in self.cut(normalised(text)) for i in self.encode_part(part)]

    def decode_part(self, ids: list[int]) -> str:
        """The text that ids spell, spaces before it included; byte pieces that spell no character become U+FFFD."""
        try:
            return "".join(map(self.texts.__getitem__, ids)).replace(SPACE, " ")
        except KeyError:
            out, octets = [], bytearray()
        for i in [*ids, None]:
            if i in self._byte_of:
                octets.append(self._byte_of[i])
                continue
            if octets:
                out.append(_characters(bytes(octets)))
                octets.clear()
            if i in self.texts:
                out.append(self.texts[i].replace(SPACE, " "))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the one space that encoding puts first, if it is a piece's own; ends are no text."""
        first = next((i for i in ids if i in self.texts or i in self._byte_of), None)
        text = self.decode_part(ids)
        return text if first in self._byte_of else text.removeprefix(" ")


def _characters(octets: bytes) -> str:
    """Bytes as text; each byte that belongs to no character is a U+FFFD."""
    out, at = [], 0
    while at < len(octets):
        try:
            out.append(octets[at:].decode("utf-8"))
            break
        except UnicodeDecodeError as e:
            out += [octets[at : at + e.start].decode("utf-8"), "�"]
            at += e.start + 1
    return "".join(out)


class _Parts(dict):
    """Of parts of texts their ids in decimal digits and the text that those decode to. Those that come again are
    remembered, as many as `cached` at a time."""

    def __init__(self, pieces: Pieces, cached: int):
        self.pieces, self.cached = pieces, cached

    def __missing__(self, part: str) -> tuple[str, str]:
        ids = self.pieces.encode_part(part)
        found = " ".join(map(str, ids)), self.pieces.decode_part(ids)
        if len(part) < 64:
            if len(self) >= self.cached:
                self.clear()
            self[part] = found
        return found


class TextCodec:
    """Encodes whole texts."""

    def __init__(self, pieces: Pieces, cached: int = CACHED_PARTS):
        self.pieces, self._parts = pieces, _Parts(pieces, cached)

    def _found(self, text: str) -> list[tuple[str, str]]:
        return list(map(self._parts.__getitem__, self.pieces.cut(normalised(text))))

    def _digits(self, found: list[tuple[str, str]]) -> str:
        return " ".join([f[0] for f in found] + [str(self.pieces.end_id)])

    def encode(self, text: str) -> list[int]:
        return list(map(int, self._digits(self._found(text)).split()))

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids with the end, SHA-256 of the decimal ids, SHA-256 of what they decode to)"""
        found = self._found(text)
        ids, decoded = self._digits(found), "".join([f[1] for f in found]).removeprefix(" ")
        return ids.count(" ") + 1, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode("utf-8")).hexdigest()


_CODECS: dict[str, TextCodec] = {}


class SharedPieces:
    """A model's pieces on the executors: as large as the model, whatever the input."""

    def __init__(self, spark: SparkSession, path: str):
        self._broadcast, self.id = spark.sparkContext.broadcast(Pieces.load(path).tables()), uuid.uuid4().hex

    def codec(self) -> TextCodec:
        """This worker's codec."""
        if self.id not in _CODECS:
            _CODECS.clear()
            _CODECS[self.id] = TextCodec(Pieces(*self._broadcast.value))
        return _CODECS[self.id]


def encode_column(text: Column, pieces: SharedPieces) -> Column:
    """Column of array<int>: the ids of each text and the end id; null for null."""

    @F.pandas_udf("array<int>")
    def encoded(texts: pd.Series) -> pd.Series:
        return texts.map(pieces.codec().encode, na_action="ignore")

    return encoded(text)


def decode_column(ids: Column, pieces: SharedPieces) -> Column:
    """Column of string: the text of each array of ids; null for null. Ids that the model lacks are no text."""

    @F.pandas_udf("string")
    def decoded(rows: pd.Series) -> pd.Series:
        decode = pieces.codec().pieces.decode
        return rows.map(lambda r: decode([int(i) for i in r]), na_action="ignore")

    return decoded(ids)


def digest_column(text: Column, pieces: SharedPieces) -> Column:
    """Column of struct(n_tokens, ids_sha256, decoded_sha256): each text is encoded, its ids decoded again.

    A null text is empty: the end id alone, and nothing to decode. A text is worked on whole, however long, in time and
    memory in proportion to it. Rows do not depend on each other, so repeated rows and ids need no rule, an empty table
    gives an empty result, and other columns are not looked at.
    """

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pd.Series) -> pd.DataFrame:
        codec = pieces.codec()
        return pd.DataFrame([codec.digest(t or "") for t in texts], columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digests(text)
