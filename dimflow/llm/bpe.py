"""Byte-level BPE by prefix dynamic programming.

Merging by rank has a local test: a sequence of tokens is the encoding of its bytes exactly if every two neighbours,
taken alone, encode to themselves. So every prefix of a piece has one last token: the only one that ends there and fits
the last token of the prefix before it. A table of these last tokens gives the encoding by walking back from the end.
Appending bytes extends the table and changes nothing in it; after an edit only the entries behind it are made anew.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.llm.common import binary_array, int_lists, kept, no_collector, pieces_of, tidy

#: White space other than blank, tab and line ends: texts that have it are split by the pattern as a whole.
_RARE_SPACE = regex.compile(r"[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
#: A run of white space and what follows it. No piece of the pattern goes on from other characters into white space, and
#: no piece looks further than the first character after white space, so these parts are encoded apart.
_PART = regex.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
#: White space that a blank follows: such texts are cut into parts one by one.
_RUNS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
#: Parts that a worker remembers, and the longest worth it (characters); bytes of texts that are encoded together.
MEMORY, REMEMBERED, TOGETHER = 100_000, 64, 1 << 21
#: Longest piece whose table is worked out from its end, by recursion; longer ones from the start.
DEEPEST = 256


def parse_ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines()) if token}


class Ranks:
    """A vocabulary: token bytes by rank, with the test of neighbours."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(ranks.get(bytes([b]), 256) > 255 for b in range(256)):
            raise ValueError("the first 256 ranks must be the single bytes")
        self.ids = ranks
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token
        self.longest = max(map(len, ranks))
        self.lengths = list(map(len, self.bytes))
        self.fits: dict[tuple[int, int], bool] = {}
        self._made: dict[int, tuple[int, int] | None] = {}
        #: Tokens but those that merging never gives.
        self.usable = {token: i for token, i in ranks.items() if i < 256 or self.made(i)}

    @cached_property
    def endings(self) -> ahocorasick.Automaton:
        """Finds every usable token that ends at a place, longest first; built when a long piece first needs it."""
        found = ahocorasick.Automaton()
        for token, i in self.usable.items():
            found.add_word(token.decode("latin-1"), i)
        found.make_automaton()
        return found

    @classmethod
    def parse(cls, lines: bytes) -> Ranks:
        """From lines of a base64 token and its rank."""
        return cls(parse_ranks(lines))

    def merged(self, data: bytes, down_to: int = 1) -> list[int]:
        """Merge by definition, the pair of lowest rank first, until ``down_to`` parts are left or nothing merges."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > down_to:
            pairs = [(self.ids.get(a + b, len(self.bytes)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            rank, i = min(pairs)
            if rank == len(self.bytes):
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ids[p] for p in parts]

    def made(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge gives ``token``; None if merging its bytes does not give it."""
        if token not in self._made:
            parts = self.merged(self.bytes[token], 2)
            if max(parts) >= token:
                raise ValueError("a token must rank after the tokens it is made of")
            self._made[token] = tuple(parts) if len(parts) == 2 else None
        return self._made[token]

    def fit(self, pair: tuple[int, int]) -> bool:
        """Whether the two tokens side by side are the encoding of their bytes.

        Merges are undone from the last to the first on both sides of the boundary. The tokens do not fit if at some
        moment the two that touch there would have merged before either was used up on its own side; of equal
        ranks the left one merges first.
        """
        if len(self.fits) > 300_000:
            self.fits.clear()
        known = self.fits[pair] = self._fit(*pair)
        return known

    def _fit(self, left: int, right: int) -> bool:
        left_used = right_used = len(self.bytes)
        while True:
            across = self.ids.get(self.bytes[left] + self.bytes[right])
            if across is not None and across < left_used and across <= right_used:
                return False
            if left > right and left > 255:
                left_used, left = left, self.made(left)[1]
            elif right > 255:
                right_used, right = right, self.made(right)[0]
            else:
                return True


    def extend(self, data: bytes, last: list[int], begin: int) -> None:
        """Add the last tokens of the prefixes of ``data`` beyond ``begin``; ``last`` has those up to it."""
        lengths, known, fit = self.lengths, self.fits, self.fit
        back = begin - self.longest + 1 if begin >= self.longest else 0
        end, base = begin + 1, back + 1
        for at, token in self.endings.iter(data[back:].decode("latin-1")):
            if at + base == end:  # else that prefix has its last token
                start = end - lengths[token]
                if start:
                    pair = (last[start], token)
                    fits = known.get(pair)
                    if not (fit(pair) if fits is None else fits):
                        continue
                last.append(token)
                end += 1

    def last_token(self, data: bytes, end: int, last: list[int | None]) -> int:
        """The last token of the prefix of ``data`` that ends at ``end``, from ``last``, where it is put as well.

        Only the prefixes that its candidates ask for are worked out, the longest candidate first. As the valid one is
        unique, the order changes the work only.
        """
        usable, known = self.usable, self.fits
        start = end - self.longest if end > self.longest else 0
        while True:
            token = usable.get(data[start:end])
            if token is not None:
                if not start:
                    break
                before = last[start]
                if before is None:
                    before = self.last_token(data, start, last)
                pair = (before, token)
                fits = known.get(pair)
                if self.fit(pair) if fits is None else fits:
                    break
            start += 1
        last[end] = token
        return token

    def tokens(self, data: bytes) -> list[int]:
        """The tokens of a piece that is no token itself."""
        size = len(data)
        if size > DEEPEST:
            last = [-1]
            self.extend(data, last, 0)
        else:
            last = [None] * (size + 1)
            self.last_token(data, size, last)
        return self.walk(last)

    def walk(self, last: list[int]) -> list[int]:
        """The tokens of the whole, from the last tokens of its prefixes."""
        lengths, out, end = self.lengths, [], len(last) - 1
        while end:
            token = last[end]
            out.append(token)
            end -= lengths[token]
        out.reverse()
        return out


class PieceTable:
    """Bytes of one piece with the last token of every prefix."""

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks, self.data, self.last = ranks, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Exact: entries of shorter prefixes stay as they are."""
        begin = len(self.data)
        self.data += more
        self.ranks.extend(self.data, self.last, begin)

    def truncate(self, size: int) -> None:
        self.data, self.last = self.data[:size], self.last[: size + 1]

    def replace(self, start: int, stop: int, new: bytes) -> None:
        """Put ``new`` in place of data[start:stop]; only prefixes beyond ``start`` are worked out again."""
        tail = self.data[stop:]
        self.truncate(start)
        self.append(new + tail)

    def tokens(self) -> list[int]:
        whole = self.ranks.ids.get(self.data)
        if whole is not None:  # a piece that is a token is never merged, also where merging would not give it
            return [whole]
        return self.ranks.walk(self.last)


class Encoder:
    """Encodes texts piece by piece and remembers frequent parts in two generations of bounded size."""

    def __init__(self, ranks: Ranks, pattern: str):
        self.ranks, self.pieces = ranks, regex.compile(pattern)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, text: str) -> list[int]:
        return array("i", self.packed(pa.array([text]))[0]).tolist()

    def packed(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers; texts may be null.

        Texts are cut at their blanks by Arrow, and each distinct part, a blank with what follows it, is looked up once.
        A blank behind other white space does not start a part, so texts that have such are cut one by one.
        """
        found = [b""] * len(texts)
        runs = pc.match_substring_regex(texts, _RUNS)  # null where the text is
        for i in pc.indices_nonzero(runs).to_pylist():
            found[i] = self._text(texts[i].as_py())
        plain = pc.indices_nonzero(pc.invert(runs))
        for i, ids in zip(plain.to_pylist(), self._cut(texts.take(plain)), strict=True):
            found[i] = ids
        return found

    def _cut(self, texts: pa.Array) -> list[bytes]:
        """Texts in which every blank starts a part."""
        lists = pc.split_pattern(texts, " ")
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        distinct = lists.flatten().dictionary_encode()
        coded = self._parts([f" {part}" for part in distinct.dictionary.to_numpy(zero_copy_only=False)])
        firsts = [self._first(text) for text in pc.list_element(lists, 0).to_numpy(zero_copy_only=False)]
        ids = np.frombuffer(b"".join(coded), "<u4")
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        places = np.cumsum(sizes) - sizes
        parts = distinct.indices.to_numpy()
        counts = sizes[parts]
        counts[bounds[:-1]] = 0  # the first part of a text has no blank
        done = np.concatenate([[0], np.cumsum(counts)])
        flat = ids[np.repeat(places[parts] - done[:-1], counts) + np.arange(done[-1])].tobytes()
        ends = (done[bounds] * 4).tolist()
        return [first + flat[a:b] for first, a, b in zip(firsts, ends, ends[1:], strict=False)]

    def _parts(self, parts: list[str]) -> list[bytes]:
        young = self.young
        found = list(map(young.get, parts))
        if None in found:
            for i, known in enumerate(found):
                if known is None:
                    found[i] = self._part(parts[i])
        return found

    def _first(self, part: str) -> bytes:
        return self._part(part) if part else b""

    def _text(self, text: str) -> bytes:
        """A text by its own parts."""
        if _RARE_SPACE.search(text):
            return self._direct(text)
        return b"".join(self._parts(_PART.findall(text)))

    def _part(self, part: str) -> bytes:
        """A part that may not be in the young generation."""
        known = self.young.get(part) or self.old.get(part)
        if known is None:
            word = part[1:] if part[0] == " " else part
            if word.isalpha():  # one piece
                known = self._piece(part)
            elif word[:-1].isalpha() and word[-1] in ".,":  # two
                known = self._known(part[:-1]) + self._piece(part[-1])
            elif not word or _RARE_SPACE.search(word):
                known = self._direct(part)
            else:
                parts = _PART.findall(part)
                known = b"".join(map(self._part, parts)) if len(parts) > 1 else self._direct(part)
        self._remember(part, known)
        return known

    def _known(self, piece: str) -> bytes:
        known = self.young.get(piece) or self.old.get(piece)
        if known is None:
            known = self._piece(piece)
            self._remember(piece, known)
        return known

    def _remember(self, part: str, known: bytes) -> None:
        if len(part) <= REMEMBERED:
            if len(self.young) >= MEMORY:
                self.young, self.old = {}, self.young
            self.young[part] = known

    def _direct(self, text: str) -> bytes:
        return b"".join(map(self._known, self.pieces.findall(text)))

    def _piece(self, piece: str) -> bytes:
        data = piece.encode("utf-8", "surrogatepass")
        whole = self.ranks.ids.get(data)
        if whole is not None:  # a piece that is a token is never merged, also where merging would not give it
            return whole.to_bytes(4, "little")
        return array("i", self.ranks.tokens(data)).tobytes()


class EditableText:
    """A text kept encoded under appends and edits: pieces away from the change keep their tables."""

    def __init__(self, ranks: Ranks, pattern: str, text: str = ""):
        self.ranks, self.pattern, self.text = ranks, regex.compile(pattern), text
        self.ends: list[int] = []
        self.tables: list[PieceTable] = []
        self._split(0, 0, [], [], 0)

    def _split(self, first: int, begin: int, old_ends: list[int], old_tables: list[PieceTable], settled: int) -> None:
        """Split again from piece ``first`` at ``begin`` until a boundary at or beyond ``settled`` meets an old one."""
        ends, tables = self.ends[:first], self.tables[:first]
        old = {end: k for k, end in enumerate(old_ends)}
        for match in self.pattern.finditer(self.text, begin):
            data = match.group().encode("utf-8", "surrogatepass")
            ends.append(match.end())
            tables.append(self._table(data, len(tables)))
            if match.end() >= settled and match.end() in old:
                k = old[match.end()] + 1
                ends += old_ends[k:]
                tables += old_tables[k:]
                break
        self.ends, self.tables = ends, tables

    def _table(self, data: bytes, place: int) -> PieceTable:
        """The table of the piece that was here, cut back to the common prefix and extended."""
        if place < len(self.tables):
            before = self.tables[place]
            same = next((i for i, (a, b) in enumerate(zip(before.data, data, strict=False)) if a != b), min(len(before.data), len(data)))
            if same:
                table = PieceTable(self.ranks)
                table.data, table.last = data[:same], before.last[: same + 1]
                table.append(data[same:])
                return table
        return PieceTable(self.ranks, data)

    def replace(self, start: int, stop: int, new: str) -> None:
        shift = len(new) - (stop - start)
        self.text = self.text[:start] + new + self.text[stop:]
        # A piece depends on itself and one character behind it: pieces that end before ``start`` stay, white space
        # runs are one piece or two and begin anew with the piece before.
        first = max(0, sum(end < start for end in self.ends) - 1)
        begin = self.ends[first - 1] if first else 0
        moved = [(end + shift, table) for end, table in zip(self.ends, self.tables, strict=True) if end > stop]
        self._split(first, begin, [end for end, _ in moved], [table for _, table in moved], start + len(new) + 1)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def tokens(self) -> list[int]:
        return [token for table in self.tables for token in table.tokens()]


def _encoder(shared, pattern: str) -> Encoder:
    """One encoder per Python worker, so that later tasks find its memory filled."""
    return kept(("bpe", hash(shared.value), pattern), lambda: Encoder(Ranks.parse(shared.value), pattern))


def share_vocabulary(spark: SparkSession, path: str):
    """The rank file, read on the driver and broadcast: a vocabulary has a fixed size (here below 1 MB)."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, vocabulary: str, pattern: str, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the token ids of the whole text as an array of integers.

    ``vocabulary`` is the path of a rank file. Null and empty texts get an empty array; texts of any length are encoded
    whole. A column named like ``ids`` is replaced. Other columns and repeated rows pass through unchanged.
    """
    shared = share_vocabulary(docs.sparkSession, vocabulary)

    @F.arrow_udf("array<int>")
    def to_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return tidy(coded(batches))

    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _encoder(shared, pattern)
        for batch in batches:
            with no_collector():
                found = [ids for texts in pieces_of(batch, TOGETHER) for ids in encoder.packed(texts)]
            yield int_lists(found)

    return docs.withColumn(ids, to_ids(F.col(text)))


def decoder(spark: SparkSession, vocabulary: str) -> Callable[[Column], Column]:
    """A column function from token ids to their bytes. A null array gives none; an unknown id is an error."""
    shared = share_vocabulary(spark, vocabulary)

    @F.arrow_udf("binary")
    def to_bytes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = kept(("bpe-bytes", hash(shared.value)), lambda: _token_bytes(shared.value))
        for batch in batches:
            yield binary_array(_decoded(batch, table))

    return to_bytes


def _token_bytes(lines: bytes) -> list[bytes]:
    ranks = parse_ranks(lines)
    table = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        table[i] = token
    return table


def _decoded(lists: pa.ListArray, table: list[bytes]) -> list[bytes]:
    values, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_pylist()
    return [b"".join(map(table.__getitem__, values[a:b].tolist())) for a, b in zip(ends, ends[1:], strict=False)]


PACKED = T.StructType([T.StructField("packed", T.BinaryType()), T.StructField("decoded", T.BinaryType())])


def packed_and_decoded(spark: SparkSession, vocabulary: str) -> Callable[[Column], Column]:
    """A column function from token ids to a struct of them as :func:`pack_ids` gives them, and their bytes."""
    shared = share_vocabulary(spark, vocabulary)

    @F.arrow_udf(PACKED)
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = kept(("bpe-bytes", hash(shared.value)), lambda: _token_bytes(shared.value))
        for batch in batches:
            columns = [binary_array(_packed(batch)), binary_array(_decoded(batch, table))]
            yield pa.StructArray.from_arrays(columns, ["packed", "decoded"])

    return both


def decode(docs: DataFrame, vocabulary: str, *, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of the token ids; a column named like ``out`` is replaced."""
    return docs.withColumn(out, decoder(docs.sparkSession, vocabulary)(F.col(ids)))


def pack_ids(ids: Column) -> Column:
    """Token ids as little-endian unsigned 32-bit integers; a null array is empty."""

    @F.arrow_udf("binary")
    def pack(batch: pa.Array) -> pa.Array:
        return binary_array(_packed(batch))

    return pack(ids)


def _packed(lists: pa.ListArray) -> list[bytes]:
    values, ends = lists.values.to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_numpy()
    return [values[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]
