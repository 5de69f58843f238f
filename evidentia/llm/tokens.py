"""Token ids by the tokenizers library, with the words between single spaces and line ends remembered."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: When a worker remembers more than MOST pieces, the KEPT that it has seen most often stay; when they and their ids are of
#: more than HELD bytes, as many of these as half of that holds.
KEPT, MOST, HELD = 300_000, 500_000, 96 << 20

#: Pieces that go through the library in one call.
TOGETHER = 1_000

#: Texts that are cut and looked up at a time, by number and by bytes.
ROWS, BYTES = 1_000, 4 << 20

#: Pieces whose ids are put in place at a time.
PLACED = 1 << 16

#: White space, in the widest sense, at a text's start or twice in a row; such texts are cut with more care.
_WIDE = r"(^|[\s\p{Z}\x0b\x1c-\x1f\x{85}])[\s\p{Z}\x0b\x1c-\x1f\x{85}]"
#: Pieces that aren't joined with others: without any character but a line end, or with white space inside.
_ODD = r"^\n?$|.[\s\p{Z}\x0b\x1c-\x1f\x{85}]|^[^\n\S]|^[\p{Z}\x0b\x1c-\x1f\x{85}]"
_CUT = re.compile(r"(?<=\S) (?=\S)")

#: Texts that must come out alike in pieces and as a whole, or else whole texts are encoded.
_PROBES = (
    "One two, three.\nFour  five \n six\t seven 8 9's", " lead", "trail ", "", "a b c\r\nd", "\n", "\nstart", "end\n", "straße.\nñandú тест!\n漢字 a; \xa0b", "x <|endoftext|> y\n<|endoftext|>",
    "One two, three.\nFour five's six!!!\n- 8 9", "tab\tx y\t\nz",
)


class PieceEncoder:
    """Same ids as ``Tokenizer.encode(text, add_special_tokens=False)``.

    A byte-level pre-tokenizer takes a single space between two other characters as the start of the next word, and a
    single line end as a word of its own. So a text may be cut before such spaces and line ends, and each distinct piece
    goes through the library once: many together in one text, whose ids are cut again where a token starts with the space
    or the line end. A piece is noted without its space, but with its line end; a text's first piece counts as if a line
    end stood before it. Texts with other white space (two in a row, or at the start) are cut before single spaces alone.

    Every look-up goes over all that is remembered once, so the more is remembered the more texts should come at a time.
    """

    def __init__(self, path: str, kept: int = 0, most: int = 0, rows: int = 0, size: int = 0, held: int = 0):
        from tokenizers import Tokenizer

        self.kept, self.most, self.rows, self.bytes, self.held = kept or KEPT, most or MOST, rows or ROWS, size or BYTES, held or HELD
        self.library = Tokenizer.from_file(path)
        self.vocabulary = self.library.get_vocab_size()
        names = [self.library.id_to_token(i) or "" for i in range(self.vocabulary)]
        # a byte-level vocabulary writes the byte b, if it isn't visible, as the character 256 + b
        self.spaced, self.lined = (np.array([x.startswith(chr(256 + ord(c))) for x in names]) for c in " \n")
        self.known, self.ids = pa.array([], pa.string()), np.empty(0, np.uint32)
        # of each place: where its ids begin, how many there are, how often it was seen
        self.begin, self.size, self.seen = (np.empty(0, np.int64) for _ in range(3))
        self.cuts = True
        self.cuts = self._each(["\n"]) == [np.flatnonzero(self.lined & (np.char.str_len(names) == 1)).tolist()]
        if self.cuts:
            whole = [self._whole(p) for p in _PROBES]
            self.cuts = all(np.array_equal(x, y) for x, y in zip(self.encode(list(_PROBES)), whole, strict=True)) and self.count(list(_PROBES)) == [len(x) for x in whole]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _each(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, pieces: pa.Array, lead: str, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of pieces that, with ``lead``, begin with a token for which ``starts`` holds, and have no other."""
        ids, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for i in range(0, len(pieces), TOGETHER):
            some = pieces.slice(i, TOGETHER)
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some), lead)[0].as_py()
            found = np.array(self._each([lead + joined])[0], np.uint32)
            cut = np.flatnonzero(starts[found])
            if len(cut) == len(some) and cut[0] == 0:
                ids.append(found)
                sizes.append(np.diff(cut, append=len(found)))
            else:  # not a text that can be cut again
                each = self._each([lead + x for x in some.to_pylist()])
                ids += [np.array(x, np.uint32) for x in each]
                sizes.append(np.fromiter(map(len, each), np.int64, len(each)))
        return np.concatenate(ids), np.concatenate(sizes)

    def _new(self, pieces: pa.Array) -> None:
        """Encodes distinct pieces and puts them and their ids at the end."""
        lined = pc.starts_with(pieces, "\n")
        odd = pc.match_substring_regex(pieces, _ODD)
        kinds = [pc.and_not(pc.invert(odd), lined), pc.and_not(lined, odd), odd]
        places = [np.flatnonzero(k.to_numpy(zero_copy_only=False)) for k in kinds]
        rest = pieces.take(pa.array(places[2])).to_pylist()
        each = self._each([x if x[:1] == "\n" else " " + x for x in rest])
        found = [
            self._together(pieces.take(pa.array(places[0])), " ", self.spaced),
            self._together(pieces.take(pa.array(places[1])), "", self.lined),
            (np.fromiter((x for ids in each for x in ids), np.uint32), np.fromiter(map(len, each), np.int64, len(each))),
        ]
        sizes = np.concatenate([n for _, n in found])
        begin = len(self.ids) + np.cumsum(sizes) - sizes
        back = np.argsort(np.concatenate(places))
        self.begin, self.size = np.concatenate((self.begin, begin[back])), np.concatenate((self.size, sizes[back]))
        self.ids = np.concatenate((self.ids, *(x for x, _ in found)))
        self.seen = np.concatenate((self.seen, np.zeros(len(pieces), np.int64)))
        self.known = pa.concat_arrays((self.known, pieces))

    def _look_up(self, pieces: pa.Array) -> np.ndarray:
        """The places of these pieces, all of them encoded."""
        if len(self.known) > self.most or self.known.nbytes + self.ids.nbytes > self.held:
            self._forget()
        coded = pieces.dictionary_encode()
        place = pc.fill_null(pc.index_in(coded.dictionary, value_set=self.known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        if len(new := np.flatnonzero(place < 0)):
            place[new] = len(self.known) + np.arange(len(new))
            self._new(coded.dictionary.take(pa.array(new)))
        at = coded.indices.to_numpy()
        self.seen[place] += np.bincount(at, minlength=len(place))
        return place[at]

    def _gathered(self, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The ids from ``begin`` on, ``sizes`` of each, one after the other."""
        ends = np.cumsum(sizes)
        out = np.empty(int(sizes.sum()), np.uint32)
        for i in range(0, len(sizes), PLACED):
            n = sizes[i : i + PLACED]
            first = ends[i : i + PLACED] - n
            a, b = int(first[0]), int(ends[i : i + PLACED][-1])
            out[a:b] = self.ids[np.repeat(begin[i : i + PLACED] - first, n) + np.arange(a, b)]
        return out

    def _forget(self) -> None:
        """Leaves the pieces seen most often, few enough and small enough."""
        often = np.argsort(-self.seen, kind="stable")[: self.kept]
        bulk = pc.binary_length(self.known).to_numpy()[often] + self.size[often] * self.ids.itemsize
        often = np.sort(often[np.cumsum(bulk) <= self.held // 2])
        self.known, self.seen, sizes = self.known.take(pa.array(often)), self.seen[often], self.size[often]
        self.ids = self._gathered(self.begin[often], sizes)
        self.begin, self.size = np.cumsum(sizes) - sizes, sizes

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, sizes, number of pieces of each text): where the ids of each piece of these texts are."""
        texts = pc.replace_substring(texts, "\n", " \n")
        texts = pc.binary_join_element_wise(pa.scalar("\n", texts.type), texts, pa.scalar("", texts.type))
        lists = pc.split_pattern(texts, " ")
        places = self._look_up(lists.flatten())
        n = np.diff(lists.offsets.to_numpy())
        begin, sizes = self.begin[places], self.size[places]
        first = np.cumsum(n) - n
        begin[first] += 1  # the line end that doesn't stand there
        sizes[first] -= 1
        return begin, sizes, n

    def _careful(self, text: str) -> np.ndarray:
        """A text with other white space; its first piece isn't remembered."""
        first, *rest = _CUT.split(text)
        head = np.array(self._each([first])[0], np.uint32)
        if not rest:
            return head
        places = self._look_up(pa.array(rest))
        return np.concatenate((head, self._gathered(self.begin[places], self.size[places])))

    def encode_arrow(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each); null counts as empty."""
        ids, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for plain, some in self._parts(texts):
            if plain:
                begin, of_piece, n = self._cut(some)
                ids.append(self._gathered(begin, of_piece))
                sizes.append(_sums(of_piece, n))
            else:
                found = [self._careful(x) if self.cuts else self._whole(x) for x in some.to_pylist()]
                ids += found
                sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
        pa.default_memory_pool().release_unused()  # a worker lives on beside others
        return np.concatenate(ids), np.concatenate(sizes)

    def count_arrow(self, texts: pa.Array) -> np.ndarray:
        """The number of ids of each text; null counts as empty."""
        sizes = [np.empty(0, np.int64)]
        for plain, some in self._parts(texts):
            if plain:
                _, of_piece, n = self._cut(some)
                sizes.append(_sums(of_piece, n))
            else:
                sizes.append(np.array([len(self._careful(x) if self.cuts else self._whole(x)) for x in some.to_pylist()], np.int64))
        pa.default_memory_pool().release_unused()  # a worker lives on beside others
        return np.concatenate(sizes)

    def _parts(self, texts: pa.Array) -> Iterator[tuple[bool, pa.Array]]:
        """(whether pieces are cut at every space and line end, texts) in order, some rows at a time."""
        rows = max(1, min(self.rows, len(texts) * self.bytes // max(texts.nbytes, 1)))
        for at in range(0, len(texts), rows):
            some = pc.fill_null(texts.slice(at, rows), pa.scalar("", texts.type))
            if not self.cuts:
                yield False, some
                continue
            wide = pc.match_substring_regex(some, _WIDE).to_numpy(zero_copy_only=False)
            turns = [0, *(np.flatnonzero(np.diff(wide)) + 1).tolist(), len(some)]
            for a, b in zip(turns, turns[1:], strict=False):
                yield not wide[a], some.slice(a, b - a)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        ids, sizes = self.encode_arrow(pa.array(texts, pa.string()))
        return np.split(ids, np.cumsum(sizes)[:-1])

    def count(self, texts: list[str]) -> list[int]:
        return self.count_arrow(pa.array(texts, pa.string())).tolist()


def _sums(of_piece: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums over runs of n[0], n[1], ... pieces; every text has at least one."""
    return np.add.reduceat(of_piece, np.cumsum(n) - n)


def encoder(path: str, **sizes: int) -> PieceEncoder:
    """This process's encoder for a vocabulary and sizes: a Python worker keeps it, and what it remembers, from task to task."""
    import tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread a task, and no memory for others
    held = tokenizers.__dict__.setdefault("_evidentia_encoders", {})
    key = (path, *sorted(sizes.items()))
    if key not in held:
        held[key] = PieceEncoder(path, **sizes)
    return held[key]


def together(batches: Iterator[pa.RecordBatch], rows: int, size: int) -> Iterator[list[pa.Array]]:
    """The columns of as many batches at a time as have so many rows and bytes, or of one that has more."""
    some: list[pa.RecordBatch] = []
    for batch in batches:
        if some and (sum(x.num_rows for x in some) + batch.num_rows > rows or sum(x.nbytes for x in some) + batch.nbytes > size):
            yield [pa.concat_arrays(c) for c in zip(*some, strict=True)]
            some = []
        if batch.num_rows:
            some.append(batch)
    if some:
        yield [pa.concat_arrays(c) for c in zip(*some, strict=True)]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
