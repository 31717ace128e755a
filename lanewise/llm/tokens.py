"""Token ids of whole texts by a public tokenizer file, with the ids of common pieces remembered.

A text is cut before single spaces and line breaks between visible characters.
The tokenizers used here never join characters across such a place: their
patterns take a blank only as the first character of a token, and normal forms
compose nothing with a blank. So the ids of a text are those of its pieces.

Most pieces are a word of Latin letters with signs behind it. Normal forms and patterns
leave such a word whole, so the library's model gets it directly, in lower case if the
tokenizer lowers and with its bytes written as the model's characters. Arrow finds the
distinct pieces and words of some texts; Python sees each of these once.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lanewise.session import ship_with_tasks

ship_with_tasks(__name__)

CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")

#: A character that texts hardly hold; it separates pieces that are encoded in one go.
MARK = "\x01"

#: Texts where not every space and line break is a cut, or that hold the mark.
ODD = rf"^[ \n]|[ \n]$|[ \n][ \n]|{MARK}"

#: What a piece begins with but a space, a word of Latin letters, signs of ASCII.
#: U+0130 is no such letter: in lower case it has a mark.
PLAIN = rf"^(?P<head>[\n{MARK}]?)(?P<word>[A-Za-zÀ-ÖØ-öø-įı-ɏ]+)(?P<signs>[!-/:-@\[-`{{-~]*)$"

#: Byte-level models write a byte as a visible character: itself or, if it is none, one from U+0100 on.
VISIBLE = [b for b in range(256) if 33 <= b < 127 or 161 <= b != 173]
BYTES = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in VISIBLE) if chr(b) not in f"\n{MARK}"}
WRITTEN = np.array([ord(BYTES.get(b, chr(b))) for b in range(256)], "<u2")

#: The groups of a pattern that fits no piece.
NONE = r"^(?P<head>x)(?P<word>x)(?P<signs>x)\b\B"

TEXT = pa.large_string()
RUN = pa.large_binary()


def _bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def _behind_mark(names: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(pa.scalar(MARK, TEXT), names, pa.scalar("", TEXT))


class Parts:
    """Runs of ids, one after another; Arrow copies them as their bytes."""

    def __init__(self, data: pa.Array):
        self.data = data

    @classmethod
    def of(cls, runs: list[bytes]) -> Parts:
        return cls(pa.array(runs, RUN))

    @classmethod
    def all(cls, parts: list[Parts]) -> Parts:
        return cls(pa.concat_arrays([p.data for p in parts]))

    def __len__(self) -> int:
        return len(self.data)

    def take(self, index: np.ndarray | pa.Array) -> Parts:
        """The runs ``index``, in that order."""
        return Parts(self.data.take(pa.array(index)))

    def _laid(self) -> tuple[np.ndarray, pa.Buffer | None]:
        """Where runs begin and the last ends, in bytes, and the bytes."""
        _, offsets, data = self.data.buffers()
        return np.frombuffer(offsets, np.int64)[self.data.offset : self.data.offset + len(self) + 1], data

    def runs(self) -> list[np.ndarray]:
        ends, data = self._laid()
        ids = np.frombuffer(data or b"", np.uint32, ends[-1] // 4)
        ends = (ends // 4).tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:])]

    def joined(self, starts: np.ndarray) -> Parts:
        """Runs joined to longer ones that begin at the runs ``starts``; the last ends with the last run."""
        ends, data = self._laid()
        ends = ends.take(np.append(starts, len(self)))
        return Parts(pa.Array.from_buffers(RUN, len(starts), [None, pa.py_buffer(ends), data]))


class Encoder:
    """Ids of texts as the tokenizers library gives them, without special tokens.

    ``file`` is the content of the tokenizer file. Words and odd pieces are remembered in about
    ``cache_bytes``, and those of one call besides; then no more are, until as many had to be encoded anew as are
    remembered, and all are forgotten.
    """

    #: What a remembered piece takes besides its characters and ids: two objects and a place in a table.
    ENTRY = 180

    def __init__(self, file: str, cache_bytes: int = 96 << 20):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(file)
        self.library.encode_special_tokens = True
        self.model = self.library.model
        self.cache_bytes, self.held = cache_bytes, 0
        self.known: dict[str, bytes] = {}
        #: Pieces encoded since the room is full.
        self.passed = 0
        #: Letters of either case then have the same ids; without it, case matters.
        self.lowers = '"Lowercase"' in file
        self.mark = np.array(self._ids([f" {MARK}"])[0], np.uint32)
        self.line = _bytes(self._ids(["\n"])[0])
        #: What a word begins with after a space; nothing if the tokenizer drops blanks.
        self.space = " " if len({tuple(i) for i in self._ids([" a", "a"])}) == 2 else ""
        self.plain = PLAIN
        probes = [(h, w + t) for h in (" ", "\n", "") for w in ("the", "Éßœɏ", "Qxzj") for t in ("", ",", "?!'")]
        names = pa.array([{" ": "", "": MARK}.get(h, h) + p for h, p in probes], TEXT)
        if [x.tolist() for x in self._pieces_ids(names).runs()] != self._ids([h + p for h, p in probes]):
            self.plain = NONE  # the tokenizer does not leave such words whole
            self.known, self.held = {}, 0

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, text: str) -> list[str]:
        """Pieces by name: without the space they begin with, or with what else they begin with behind a mark."""
        first, *rest = CUT.split(text)
        if MARK in text:
            return [MARK + p for p in (first, *rest)]
        return [MARK + first, *(p[1:] if p[0] == " " else p for p in rest)]

    def _spelled(self, names: list[str]) -> list[str]:
        """Words of letters as the model spells them: after a space, or after a mark without one."""
        text = "\n".join([self.space + w if w[0] != MARK else w[1:] for w in names]).encode()
        return WRITTEN.take(np.frombuffer(text, np.uint8)).tobytes().decode("utf-16-le").split("\n")

    def _words(self, names: list[str]) -> list[bytes]:
        """Ids of words of letters."""
        tokenize, runs = self.model.tokenize, []
        for at in range(0, len(names), 1 << 16):
            ids, ends = array("I"), [0]
            for w in self._spelled(names[at : at + (1 << 16)]):
                ids.extend([t.id for t in tokenize(w)])
                ends.append(4 * len(ids))
            data = ids.tobytes()
            runs += [data[a:b] for a, b in zip(ends, ends[1:])]
        return runs

    def _odd(self, names: list[str]) -> list[bytes]:
        """Ids of any pieces."""
        known: dict[str, bytes] = {}
        alone, joined = [], []
        for p in names:
            (alone if p[:1] in (MARK, "\n") else joined).append(p)
        for at in range(0, len(alone), 1024):
            part = alone[at : at + 1024]
            known.update(zip(part, map(_bytes, self._ids([p.removeprefix(MARK) for p in part]))))
        width = len(self.mark)
        groups = [joined[at : at + 256] for at in range(0, len(joined), 256)]
        texts = [" " + f" {MARK} ".join(g) + f" {MARK}" for g in groups]
        for group, ids in zip(groups, (i for at in range(0, len(texts), 64) for i in self._ids(texts[at : at + 64]))):
            flat = np.array(ids, np.uint32)
            ends = np.flatnonzero(flat == self.mark[-1])
            if len(ends) != len(group):
                raise ValueError("the tokenizer joins pieces; it can't be used with cut texts")
            data = flat.tobytes()
            begin = 0
            for p, end in zip(group, ends.tolist()):
                known[p] = data[4 * begin : 4 * (end + 1 - width)]
                begin = end + 1
        return [known[p] for p in names]

    def _known(self, names: pa.Array, encode: Callable[[list[str]], list[bytes]]) -> Parts:
        """Ids of distinct names, all of words or all of other pieces; ``encode`` gives those of new ones."""
        listed = names.to_numpy(zero_copy_only=False).tolist()
        runs = list(map(self.known.get, listed))
        missing = [p for p, run in zip(listed, runs) if run is None]
        if missing:
            fresh = encode(missing)
            if self.held > self.cache_bytes:
                self.passed += len(missing)
            else:
                self.known.update(zip(missing, fresh))
                self.held += self.ENTRY * len(missing) + sum(map(len, missing)) + sum(map(len, fresh))
            rest = iter(fresh)
            runs = [next(rest) if run is None else run for run in runs]
        return Parts.of(runs)

    def _pieces_ids(self, pieces: pa.Array) -> Parts:
        """Ids of distinct pieces: of what a word begins with, of the word and of the signs behind it."""
        found = pc.extract_regex(pieces, self.plain)
        plain = found.is_valid()
        head, word, signs = found.filter(plain).flatten()
        if self.lowers:
            word = pc.utf8_lower(word)
        if self.space:
            word = pc.if_else(pc.equal(head, ""), word, _behind_mark(word))
        word, signs = word.dictionary_encode(), _behind_mark(signs).dictionary_encode()
        words = self._known(word.dictionary, self._words)
        ends = self._known(signs.dictionary, self._odd)
        odd = self._known(pieces.filter(pc.invert(plain)), self._odd)
        parts = [Parts.of([b"", self.line]), words, ends, odd]
        is_plain = plain.to_numpy(zero_copy_only=False)
        index = np.zeros((len(pieces), 3), np.int64)
        at = 2
        index[is_plain, 0] = pc.equal(head, "\n").to_numpy(zero_copy_only=False)
        index[is_plain, 1] = word.indices.to_numpy() + at
        at += len(words)
        index[is_plain, 2] = signs.indices.to_numpy() + at
        at += len(ends)
        index[~is_plain, 1] = np.arange(len(odd)) + at
        return Parts.all(parts).take(index.reshape(-1)).joined(np.arange(0, index.size, 3))

    def _texts_ids(self, pieces: pa.Array, starts: np.ndarray) -> list[np.ndarray]:
        """Ids of the texts whose pieces begin at ``starts``."""
        coded = pieces.dictionary_encode()
        return self._pieces_ids(coded.dictionary).take(coded.indices).joined(starts).runs()

    def encode(self, texts: list[str | None] | pa.Array) -> list[np.ndarray]:
        """The ids of each text as 32-bit numbers; null texts count as empty."""
        if self.passed > len(self.known):
            self.known, self.held, self.passed = {}, 0, 0
        texts = (pa.array(texts, TEXT) if isinstance(texts, list) else texts.cast(TEXT)).fill_null("")
        odd = pc.match_substring_regex(texts, ODD)
        even = pc.replace_substring(texts.filter(pc.invert(odd)), "\n", " \n")
        lists = pc.split_pattern(_behind_mark(even), " ")
        rows = iter(self._texts_ids(lists.flatten(), lists.offsets.to_numpy()[:-1]))
        cut = [self._cut(t) for t in texts.filter(odd).to_pylist()]
        starts = np.cumsum([0, *map(len, cut)])[:-1]
        odd_rows = iter(self._texts_ids(pa.array([p for pieces in cut for p in pieces], TEXT), starts))
        return [next(odd_rows if is_odd else rows) for is_odd in odd.to_pylist()]
