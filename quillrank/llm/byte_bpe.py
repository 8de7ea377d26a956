"""Byte-level BPE by prefix dynamic programming.

In a BPE vocabulary each byte prefix of a piece has exactly one token that can end it. The encoder
stores that token for every prefix, so text can be appended, cut or edited without starting over:
only the prefixes after the first changed byte are looked at again.

Defined results: a null or empty text has no tokens and decodes to nothing; rows are independent, so
repeated rows, ties and further columns do not matter; an empty table gives an empty table; texts are
never cut. Unknown bytes cannot occur: every single byte must be in the vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.llm.common import give_back, held, map_batches

# Fixed value: the characters with the Unicode property White_Space.
SPACES = r"\t-\r \x85\xa0  -     　"
#: Pieces and token pairs that a Python worker remembers of each; beyond it they are emptied.
REMEMBERED = 300_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def piece_splitter(pattern: str) -> regex.Pattern:
    """The pattern with white space as Unicode defines it, which excludes the control characters 28 to 31."""
    spelled = pattern.replace(r"[^\s", f"[^{SPACES}").replace(r"\S", f"[^{SPACES}]").replace(r"\s", f"[{SPACES}]")
    return regex.compile(spelled)


class Vocabulary:
    """Ranks, what each token was merged from, and which tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        missing = [byte for byte in range(256) if bytes([byte]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks the single bytes {missing}")
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.lengths = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self._edges: dict[int, tuple[list[tuple[bytes, int]], list[tuple[bytes, int]]] | None] = {}
        self._pairs: dict[int, bool] = {}  # by left << 32 | right
        self._matches = ahocorasick.Automaton()
        for token, rank in ranks.items():  # one character a byte
            self._matches.add_word(token.decode("latin-1"), (rank, len(token)))
        self._matches.make_automaton()

    def merged(self, data: bytes) -> tuple[list[bytes], list[tuple[bytes, bytes]]]:
        """Plain merging, lowest rank and leftmost first: the parts left and the merges made."""
        parts, made = [data[i : i + 1] for i in range(len(data))], []
        while len(parts) > 1:
            rank, at = min(
                ((self.ranks.get(a + b, 1 << 62), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))),
            )
            if rank == 1 << 62:
                break
            made.append((parts[at], parts[at + 1]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts, made

    def edges(self, token: int):
        """What ends and what starts the token while it is merged, each with the rank that replaces it.

        None if merging the token's own bytes gives something else: it is never the result of a merge.
        """
        if token not in self._edges:
            data = self.tokens[token]
            parts, made = self.merged(data)
            if len(parts) > 1:
                self._edges[token] = None
            else:
                children = {a + b: (a, b) for a, b in made}
                ends, starts = [(data, 1 << 62)], [(data, 1 << 62)]
                for side, edge in ((1, ends), (0, starts)):
                    while len(edge[-1][0]) > 1:
                        edge.append((children[edge[-1][0]][side], self.ranks[edge[-1][0]]))
                    edge.reverse()
                self._edges[token] = ends, starts
        return self._edges[token]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether no merge ever crosses the seam between the two tokens.

        Both sides grow towards the whole tokens in the order of ranks; the pair at the seam must
        never be the next merge. At equal ranks the leftmost merge comes first.
        """
        known = self._pairs.get(left << 32 | right)
        if known is not None:
            return known
        (ends, _), (_, starts) = self.edges(left), self.edges(right)
        i = j = 0
        apart = True
        while True:
            (a, grows_a), (b, grows_b) = ends[i], starts[j]
            seam = self.ranks.get(a + b)
            if seam is not None and seam < grows_a and seam <= grows_b:
                apart = False
                break
            if grows_a == grows_b == 1 << 62:
                break
            if grows_a <= grows_b:
                i += 1
            else:
                j += 1
        if len(self._pairs) >= REMEMBERED:
            self._pairs.clear()
        self._pairs[left << 32 | right] = apart
        return apart

    def forget_pairs(self) -> None:
        self._pairs.clear()

    def extend(self, last: list[int], data: bytes) -> None:
        """Add to ``last``, which holds the last token of some prefixes of ``data``, that of all others.

        The automaton names the tokens that end at each byte; the first that may follow the token
        before it is the only one.
        """
        done = len(last) - 1
        edge_of, pair_of = self._edges.get, self._pairs.get
        text, from_byte = data.decode("latin-1"), max(0, done - self.longest)
        for at, (token, length) in self._matches.iter(text, from_byte):
            if at < done:
                continue
            start = at + 1 - length
            if edge_of(token) is None and self.edges(token) is None:
                continue
            if start:
                left = last[start]
                apart = pair_of(left << 32 | token)
                if not (self.may_follow(left, token) if apart is None else apart):
                    continue
            last.append(token)
            done = at + 1

    def ids(self, data: bytes, last: list[int] | None = None) -> tuple[int, ...]:
        """Ids of a piece, walked back from the last token of the whole."""
        whole = self.ranks.get(data)
        if whole is not None:  # a piece that is itself a token stays whole
            return (whole,)
        if last is None:
            self.extend(last := [-1], data)
        out, end = [], len(data)
        while end:
            token = last[end]
            out.append(token)
            end -= self.lengths[token]
        return tuple(out[::-1])


class Prefixes:
    """The last token of each byte prefix of one piece. Grows by ``append``; ``cut`` takes it back."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        self.vocabulary.extend(self.last, self.data)

    def cut(self, length: int) -> None:
        self.data = self.data[:length]
        del self.last[length + 1 :]

    def ids(self) -> tuple[int, ...]:
        return self.vocabulary.ids(self.data, self.last)


class _Pieces(dict):
    """Ids by piece; a missing piece is encoded, and remembered unless it is very long."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.vocabulary.ids(piece.encode())
        if len(piece) > 64:
            return ids
        if len(self) >= REMEMBERED:
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Encodes and decodes whole texts, piece by piece, with a bounded memory of pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.vocabulary, self.splitter = Vocabulary(ranks), piece_splitter(pattern)
        self.pieces = _Pieces(self.vocabulary)

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.splitter.findall(text or ""))))

    def forget(self) -> None:
        """Drop the remembered pieces and pairs; the vocabulary stays."""
        self.pieces.clear()
        self.vocabulary.forget_pairs()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


class EditableText:
    """A text with its tokens that takes appends and edits, encoding again only near the change.

    Pieces before the change keep their prefix tables. Splitting starts again two pieces before it,
    as a run of white space depends on what follows, and stops as soon as the old pieces recur.
    """

    def __init__(self, encoder: Encoder, text: str = "") -> None:
        self.encoder, self.pieces, self.encoded_bytes = encoder, [], 0
        self.append(text)

    @property
    def text(self) -> str:
        return "".join(piece for piece, _ in self.pieces)

    def ids(self) -> list[int]:
        return [token for _, table in self.pieces for token in table.ids()]

    def append(self, text: str) -> None:
        length = sum(len(piece) for piece, _ in self.pieces)
        self.edit(length, length, text)

    def edit(self, start: int, end: int, text: str) -> None:
        """Replace the characters from ``start`` up to ``end``."""
        first, at = 0, 0
        while first < len(self.pieces) and at + len(self.pieces[first][0]) <= start:
            at += len(self.pieces[first][0])
            first += 1
        for _ in range(2):
            if first:
                first -= 1
                at -= len(self.pieces[first][0])
        rest, after = "".join(piece for piece, _ in self.pieces[first:]), len(self.pieces)
        changed = rest[: start - at] + text + rest[end - at :]
        old = self.pieces[first:]
        back = {}  # distance from the end of the text -> index of the old piece that starts there
        distance = 0
        for index in range(after - 1, first - 1, -1):
            distance += len(self.pieces[index][0])
            if distance <= len(rest) - (end - at):
                back[distance] = index
        fresh, seen = [], 0
        for match in self.encoder.splitter.finditer(changed):
            left = len(changed) - match.start()
            if left in back and match.start() > start - at + len(text):
                fresh.extend(self.pieces[back[left] :])
                break
            fresh.append((match.group(), self._table(match.group(), old, seen)))
            seen += 1
        self.pieces[first:] = fresh

    def _table(self, piece: str, old: list, index: int) -> Prefixes:
        """The table of a piece, from the old one at its place as far as their bytes agree."""
        data = piece.encode()
        if index < len(old):
            table = old[index][1]
            same = 0
            for a, b in zip(table.data, data):
                if a != b:
                    break
                same += 1
            reused = Prefixes(self.encoder.vocabulary)
            reused.data, reused.last = table.data[:same], table.last[: same + 1]
            reused.append(data[same:])
            self.encoded_bytes += len(data) - same
            return reused
        self.encoded_bytes += len(data)
        return Prefixes(self.encoder.vocabulary, data)


def _encoder(path: str, pattern: str) -> Encoder:
    return held(f"encoder {path} {pattern}", lambda: Encoder(load_ranks(path), pattern))


def encode(
    df: DataFrame, key: str, text: str, path: str | None = None, pattern: str | None = None
) -> DataFrame:
    """Rows of ``(key, ids array<int>, decoded binary)``; the ids are decoded again in the same task."""
    path, pattern = path or default_vocabulary(), pattern or default_pattern()
    kept = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in batches:
            ids = [encoder.encode(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())),
                 pa.array([encoder.decode(each) for each in ids], pa.binary())],
                ["key", "ids", "decoded"],
            )

    kind = kept.schema["key"].dataType.simpleString()
    return map_batches(kept, run, f"key {kind}, ids array<int>, decoded binary").withColumnRenamed("key", key)


def token_digests(
    df: DataFrame, key: str, text: str, path: str | None = None, pattern: str | None = None
) -> DataFrame:
    """``encode`` with the ids and the decoded bytes as counts and SHA-256 digests.

    The digests are taken in the same task, so that ids leave no Python worker.
    """
    path, pattern = path or default_vocabulary(), pattern or default_pattern()
    kept = df.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        written = [str(token) for token in range(max(encoder.vocabulary.tokens) + 1)]
        for batch in batches:
            counts, ids_digests, decoded_digests = [], [], []
            for text in batch.column(1).to_pylist():
                ids = encoder.encode(text)
                counts.append(len(ids))
                ids_digests.append(
                    hashlib.sha256(",".join(map(written.__getitem__, ids)).encode()).hexdigest()
                )
                decoded_digests.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_digests), pa.array(decoded_digests)],
                ["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )
        encoder.forget()
        give_back()

    kind = kept.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(kept, run, schema).withColumnRenamed("key", key)
