"""Byte-level BPE by dynamic programming over prefixes.

Every prefix of a text has exactly one last token that its encoding can end with. `last[i]` is that token for the
first i bytes: the one token that ends there, fits the bytes, and that BPE would leave standing beside the last
token of the prefix before it. Appending goes on from what is stored; an edit is encoded anew from where it starts
until the stored tokens come back into step.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from itertools import chain

import pandas as pd
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Texts are cut before white space that follows something else; every match of the pattern lies within one part.
_PART = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
#: Parts of ASCII letters, after a space or none.
_LETTERS = re.compile(" ?[A-Za-z]+")
CACHED_PARTS = 300_000
#: What was stored for prefixes of these lengths serves every piece that begins alike, longest first.
SHARED_PREFIXES = (13, 10, 7, 4)


def load_tokens(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


class Vocabulary:
    """Tokens by rank, with the two parts that each longer token was merged from."""

    def __init__(self, tokens: list[bytes], parts: list[tuple[int, int] | None] | None = None):
        self.tokens = tokens
        self.ranks = {t: i for i, t in enumerate(tokens) if t}
        self._fits: dict[int, bool] = {}
        self._prefixes: dict[bytes, list[int]] = {}
        #: The lengths that tokens with the same last three bytes have, and those of the shorter tokens they end with.
        self.lengths: dict[bytes, list[int]] = {}
        ends: dict[bytes, set[int]] = {}
        for t in self.ranks:
            if len(t) >= 3:
                ends.setdefault(t[-3:], set()).add(len(t))
        for tail, sizes in ends.items():  # longest first
            self.lengths[tail] = sorted(sizes | ({2} if tail[1:] in self.ranks else set()) | {1}, reverse=True)
        self.longest = max(map(len, self.ranks), default=0)
        self.parts = parts or self._merge_parts()

    def _merge_parts(self) -> list[tuple[int, int] | None]:
        self.parts = [None] * len(self.tokens)
        for rank, token in enumerate(self.tokens):
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None and left < rank and right < rank and self._stays(left, right, rank):
                    self.parts[rank] = (left, right)
                    break
        return self.parts

    def _stays(self, left: int, right: int, limit: int) -> bool:
        """Whether merges of a rank below `limit` leave the boundary between left and right standing. Both are
        taken apart again, the later merge first; on the way the two parts at the boundary must not be ones that
        would have been merged earlier. Of equal ranks the merge further left comes first."""
        tokens, ranks, parts = self.tokens, self.ranks, self.parts
        while True:
            across = ranks.get(tokens[left] + tokens[right])
            if across is not None and across < limit:
                return False
            if parts[left] is not None and (left > right or parts[right] is None):
                limit, left = left, parts[left][1]
            elif parts[right] is not None:
                limit, right = right + 1, parts[right][0]
            else:
                return True

    def fits(self, left: int, right: int) -> bool:
        if len(self._fits) > 1_000_000:
            self._fits.clear()
        known = self._fits[left << 32 | right] = self._stays(left, right, len(self.tokens) + 1)
        return known

    def extend(self, data: bytes, last: list[int], upto: int) -> None:
        """Fills `last`, which holds the tokens of data's first len(last) - 1 prefixes, as far as `upto`."""
        rank, sizes_of, fits, short = self.ranks.get, self.lengths.get, self._fits.get, (2, 1)
        for end in range(len(last), upto + 1):
            for size in (sizes_of(data[end - 3 : end], short) if end > 2 else short):
                start = end - size
                if start < 0:
                    continue
                token = rank(data[start:end])
                if token is None:
                    continue
                if start:
                    left = last[start]
                    known = fits(left << 32 | token)
                    if not known and (known is not None or not self.fits(left, token)):
                        continue
                last.append(token)
                break
            else:
                raise ValueError(f"no token of the vocabulary ends at byte {end}")

    def encode(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        last = [-1]
        for size in SHARED_PREFIXES:
            if size < len(data) and (known := self._prefixes.get(data[:size])) is not None:
                last = known.copy()
                break
        n = len(last)
        self.extend(data, last, len(data))
        if len(data) <= 64:
            if len(self._prefixes) > 200_000:
                self._prefixes.clear()
            for size in SHARED_PREFIXES:
                if n <= size < len(data):
                    self._prefixes[data[:size]] = last[: size + 1]
        return self.walk(last)

    def walk(self, last: list[int]) -> list[int]:
        ids, at = [], len(last) - 1
        while at:
            ids.append(last[at])
            at -= len(self.tokens[last[at]])
        return ids[::-1]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class PrefixEncoder:
    """The encoding of bytes that are appended to and edited."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self._last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.vocabulary.extend(self.data, self._last, len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Puts new in the place of data[start:stop]; returns how many prefixes were encoded anew."""
        old, shift = self._last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self._last, step = old[: start + 1], 0
        for end in range(start + 1, len(self.data) + 1):
            self.vocabulary.extend(self.data, self._last, end)
            # a token looks back over as many prefixes as the longest token has bytes
            step = step + 1 if end - shift > stop and self._last[end] == old[end - shift] else 0
            if step >= self.vocabulary.longest and end < len(self.data):
                self._last += old[end - shift + 1 :]
                return end - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        return self.vocabulary.walk(self._last)


class TextEncoder:
    """Encodes texts: each match of the pattern for itself. Parts of texts that come again are remembered."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, cached: int = CACHED_PARTS):
        self.vocabulary, self.cached, self._parts, self._pieces = vocabulary, cached, {}, {}
        self.decimals = [str(i) for i in range(len(vocabulary.tokens))]
        self._matches = regex.compile(pattern).findall
        # all that comes before the run of letters begins with a quote, so it matches such a part whole
        before, found, _ = pattern.partition(r" ?\p{L}+|")
        self._letters = _LETTERS.fullmatch if found and all(x[0] == "'" for x in before.split("|")[:-1] if x) and before[-1:] in ("", "|") else None

    def encode(self, text: str) -> list[int]:
        parts = _PART.findall(text)
        found = list(map(self._parts.get, parts))
        if None in found:
            found = [ids if ids is not None else self._part(part) for part, ids in zip(parts, found)]
        return list(chain.from_iterable(found))

    def _part(self, part: str) -> list[int]:
        known = self._parts
        found = known.get(part)
        if found is None:
            if len(known) > self.cached:
                known.clear()
            if self._letters is not None and self._letters(part):  # all one match
                found = self.vocabulary.encode(part.encode("utf-8"))
            else:
                found = [i for piece in self._matches(part) for i in self._piece(piece)]
            if len(part) < 64:
                known[part] = found
        return found

    def _piece(self, piece: str) -> list[int]:
        found = self._pieces.get(piece)
        if found is None:
            if len(self._pieces) > self.cached:
                self._pieces.clear()
            found = self.vocabulary.encode(piece.encode("utf-8"))
            if len(piece) < 64:
                self._pieces[piece] = found
        return found


_ENCODERS: dict[str, TextEncoder] = {}


def text_encoder(shared, pattern: str) -> TextEncoder:
    """This worker's encoder for a broadcast vocabulary."""
    if shared.id not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[shared.id] = TextEncoder(Vocabulary(*shared.tables), pattern)
    return _ENCODERS[shared.id]


class SharedVocabulary:
    """A vocabulary's tables on the executors: as large as the vocabulary file, whatever the input."""

    def __init__(self, spark: SparkSession, path: str):
        vocabulary = Vocabulary(load_tokens(path))
        self._broadcast = spark.sparkContext.broadcast((vocabulary.tokens, vocabulary.parts))
        self.id = uuid.uuid4().hex

    @property
    def tables(self):
        return self._broadcast.value


def encode_column(text: Column, vocabulary: SharedVocabulary, pattern: str) -> Column:
    """Column of array<int>: the ids of each text; null for null."""

    @F.pandas_udf("array<int>")
    def encoded(texts: pd.Series) -> pd.Series:
        encoder = text_encoder(vocabulary, pattern)
        return texts.map(encoder.encode, na_action="ignore")

    return encoded(text)


def decode_column(ids: Column, vocabulary: SharedVocabulary) -> Column:
    """Column of binary: the bytes of each array of ids; null for null."""

    @F.pandas_udf("binary")
    def decoded(rows: pd.Series) -> pd.Series:
        tokens = vocabulary.tables[0]
        return rows.map(lambda r: b"".join(map(tokens.__getitem__, r)), na_action="ignore")

    return decoded(ids)


def digest_column(text: Column, vocabulary: SharedVocabulary, pattern: str) -> Column:
    """Column of struct(n_tokens, ids_sha256, decoded_sha256): each text is encoded, its ids decoded again.

    A null text is empty: no ids, and nothing to decode. A text is encoded whole, however long, match by match. Rows do
    not depend on each other, so repeated rows and ids need no rule, an empty table gives an empty result, and other
    columns are not looked at.
    """

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pd.Series) -> pd.DataFrame:
        encoder, sha, out = text_encoder(vocabulary, pattern), hashlib.sha256, []
        decimal = encoder.decimals.__getitem__
        for text in texts:
            ids = encoder.encode(text or "")
            out.append((len(ids), sha(" ".join(map(decimal, ids)).encode()).hexdigest(), sha(encoder.vocabulary.decode(ids)).hexdigest()))
        return pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digests(text)
