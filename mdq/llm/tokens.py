"""Token ids of whole texts, with a memo of the pieces that white space cuts.

Both vocabularies here split a text before their merges, and no split crosses
from a character that is not white space into white space. A text may thus be
cut in front of every run of ASCII white space, and between a Latin letter and
ASCII punctuation other than the apostrophe, and its pieces encoded alone, with
the same ids as the library gives for the whole text (the capital dotted I is no
such letter). Pieces repeat, so each
worker remembers theirs. Texts with white space outside ASCII, whose runs could
be cut in the middle, are encoded whole.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"

#: İ (U+0130) is left out: lower-cased it ends in a combining mark, which the word vocabulary joins to the punctuation behind it.
_LETTERS = "[A-Za-zÀ-ÖØ-öø-įı-ſ]+(?=[!-&(-/:-@\\[-`{-~])"
_SPACED = re.compile(rf"\s*{_LETTERS}|\s*\S+|\s+", re.ASCII)
_HEAD = re.compile(_LETTERS).match
_WORDS = re.compile(r"\S+", re.ASCII).findall
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: For Arrow (RE2): white space that plain splitting could cut wrongly.
_ODD_WORDS = r"[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ODD_SPACED = r"  | \n|\n\n|[\t\r\x0b\x0c]|" + _ODD_WORDS


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


#: Pieces of one pre-token: Latin letters, with at most one space in front.
_SIMPLE = re.compile("[ ]?[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself
    where it prints, else the next one from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}


class Memo(dict):
    """What ``make`` gives for each piece asked for. Two generations of at most
    ``size`` pieces bound the memory and keep the pieces in use; pieces over
    ``max_len`` characters are not kept."""

    def __init__(self, make, size: int, max_len: int = 64):
        super().__init__()
        self.make, self.size, self.max_len, self.old = make, size, max_len, {}

    def __missing__(self, piece):
        found = self.old.get(piece)
        if found is None:
            found = self.make(piece)
        if len(piece) <= self.max_len:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[piece] = found
        return found


class PieceEncoder:
    """Encodes texts with the tokenizer file at ``path``. ``spaces``: white
    space carries tokens (byte-level vocabularies); else it separates words and
    letters are lower-cased.

    Arrow cuts many texts at single spaces and in front of line feeds (or at
    any ASCII white space) and numbers their distinct pieces; each of these is
    looked up once, and numpy puts the ids together. ``spaced`` remembers words
    with the space in front of them, ``bare`` pieces as they are. A piece that
    is one pre-token goes straight to the library's model, any other through
    its whole chain. Texts with other white space are cut by a regular
    expression, or not at all, one by one."""

    def __init__(self, path: str, spaces: bool, memo_size: int = 600_000):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model, self.letters, self.spaces = self.tok.model, byte_letters(), spaces
        self.bare = Memo(self._encode_piece, memo_size)
        self.spaced = Memo(self._encode_spaced, memo_size)

    def _encode_piece(self, p: str) -> bytes:
        if _SIMPLE(p):
            if not self.spaces:
                p = p.lower()
            word = p.encode().decode("latin-1").translate(self.letters)
            return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()
        return array("I", self.tok.encode(p, add_special_tokens=False).ids).tobytes()

    def _encode_spaced(self, p: str) -> bytes:
        return self._encode_piece(p if p.startswith("\n") else " " + p)

    def _look(self, memo: Memo, pieces: list[str]) -> list[bytes]:
        """Ids of each piece; one of letters and marks is put together from its
        parts and not remembered."""
        bare, out = self.bare, list(map(memo.get, pieces))
        for i in [i for i, x in enumerate(out) if x is None]:
            p = pieces[i]
            head = _HEAD(p)
            if head:
                end = head.end()
                word, rest = p[:end], p[end:]
                tail = bare.get(rest)
                out[i] = memo[word] + (self._look(bare, [rest])[0] if tail is None else tail)
            else:
                out[i] = memo[p]
        return out

    def _alone(self, text: str) -> bytes:
        if not text.isascii() and _OTHER_SPACE.search(text):
            return self._encode_piece(text)
        return b"".join(self._look(self.bare, _SPACED.findall(text) if self.spaces else _WORDS(text)))

    def _together(self, texts: pa.Array) -> list[bytes]:
        if self.spaces:
            cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        else:
            cut = pc.ascii_split_whitespace(texts)
        bounds = cut.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        coded = cut.flatten().dictionary_encode()
        number, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if self.spaces:                                       # no space stands before a text's first piece
            first = bounds[:-1]
            begins, which = np.unique(number[first], return_inverse=True)
            number[first] = len(words) + which
            ids = self._look(self.spaced, words) + self._look(self.bare, [words[i] for i in begins.tolist()])
        else:
            ids = self._look(self.bare, words)
        flat = np.frombuffer(b"".join(ids), "<u4")
        kind = np.int32 if texts.nbytes < 1 << 28 else np.int64    # a text has at most as many tokens as bytes
        size = np.fromiter(map(len, ids), kind, len(ids)) // 4
        start = np.cumsum(size, dtype=kind) - size
        n = size[number]
        ends = np.cumsum(n, dtype=kind)
        out = flat[np.repeat(start[number] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0, dtype=kind)].tobytes()
        at = (4 * np.append(0, ends)[bounds].astype(np.int64)).tolist()
        return [out[a:b] for a, b in zip(at, at[1:])]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text (null: empty) as little-endian unsigned 32-bit integers."""
        if not len(texts):
            return []
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD_SPACED if self.spaces else _ODD_WORDS)
        some = pc.any(odd).as_py()
        plain = iter(self._together(texts.filter(pc.invert(odd)) if some else texts) if not pc.all(odd).as_py() else [])
        if not some:
            return list(plain)
        return [self._alone(texts[i].as_py()) if x else next(plain) for i, x in enumerate(odd.to_pylist())]


_ENCODERS: dict[tuple, PieceEncoder] = {}


def encoder(path: str, spaces: bool, memo_size: int = 600_000) -> PieceEncoder:
    """This worker's encoder for a file (kept between tasks)."""
    if (path, spaces) not in _ENCODERS:
        _ENCODERS[path, spaces] = PieceEncoder(path, spaces, memo_size)
    return _ENCODERS[path, spaces]


def text_groups(texts: pa.Array, max_bytes: int = 12_000_000):
    """Ranges (start, end) of an array of texts that hold about ``max_bytes``."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(ends):
        done = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, done + max_bytes)))
        yield start, min(end, len(ends))
        start = end
