"""Token ids of whole texts, with a bounded memory of the words seen before."""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import regex

from tidemark.llm import words as w64

MEMORY = 600_000
#: Pre-tokens as the tokenizer file defines them (fixed values).
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Words of these characters are in normal form and lower-cased one character at a time.
_PLAIN = regex.compile("[!-~¡-įı-ɀ]+")
#: Marks that end a word and form one pre-token.
_ENDS = ".,;:!?*#$%&()|"
#: str.split() takes these as blanks, the tokenizer doesn't.
_CONTROL = regex.compile("[\x1c-\x1f]")


_WIDTH = 0x241
_space, _letter, _number, _mark, _odd = range(5)
#: Characters of an array pass; a longer text is a pass of its own.
_BLOCK = 1 << 21


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class and lower case of the characters that the array pass takes; the last entry stands for all others."""
    kinds, low = np.full(_WIDTH + 1, _odd, dtype=np.uint8), np.arange(_WIDTH + 1, dtype=np.uint16)
    for c in [*range(9, 14), *range(32, 127), 0x85, *range(0xA0, 0x130), *range(0x131, _WIDTH)]:
        x = chr(c)
        kinds[c] = (_space if x.isspace() else _letter if x.isalpha()
                    else _number if unicodedata.category(x)[0] == "N" else _mark)
        low[c] = ord(x.lower())
    return kinds, low


class WordEncoder:
    """Equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``, as little-endian uint32 bytes.

    The tokenizer drops white space and never joins over it, so a text is the sum of its words.
    Texts of Latin characters are cut into pre-tokens by array operations; a pre-token is known by a
    64-bit hash, and only those not seen before reach the model (up to MEMORY are remembered). In
    other texts, plain words are cut into pre-tokens and only unknown ones reach the model, many at a time (up to
    MEMORY of them are remembered); other words, and texts with odd controls, go through the
    tokenizer as they are.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.whole = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.whole.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.last = np.zeros(max(self.whole.get_vocab().values()) + 1, dtype=bool)
        for token, i in self.whole.get_vocab().items():
            self.last[i] = token.endswith("</w>")
        self.special = regex.compile("|".join(regex.escape(t.content) for t in self.whole.get_added_tokens_decoder().values()) or r"(?!)")
        self.parts: dict[str, bytes] = {}
        self.kinds, self.low = _tables()
        self.runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.flat = np.zeros(0, dtype="<u4")

    def _known(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in ``flat`` (-1: unknown) and number of ids of each pre-token."""
        at, size = np.full(len(keys), -1, dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
        for known, begin, count in self.runs:
            i = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = known[i] == keys
            at[hit], size[hit] = begin[i[hit]], count[i[hit]]
        return at, size

    def _remember(self, keys: np.ndarray, strings: list[str]) -> None:
        if sum(len(r[0]) for r in self.runs) + len(keys) > MEMORY:
            self.runs, self.flat = [], self.flat[:0]
        groups = [" ".join(strings[i:i + 512]) for i in range(0, len(strings), 512)]
        ids = np.concatenate([np.array(e.ids, dtype="<u4") for e in self.bare.encode_batch_fast(groups, add_special_tokens=False)])
        ends = np.flatnonzero(self.last[ids]) + 1
        begins = np.concatenate([[0], ends[:-1]])
        if len(ends) != len(keys):
            raise ValueError("a pre-token must end with one closing token")
        new = [keys, begins + len(self.flat), ends - begins]
        self.flat = np.concatenate([self.flat, ids])
        if len(self.runs) == 2 and len(self.runs[1][0]) + len(keys) > len(self.runs[0][0]) // 4:
            new = [np.concatenate(x) for x in zip(*self.runs, new)]
            self.runs = []
        elif len(self.runs) == 2:
            new = [np.concatenate(x) for x in zip(self.runs.pop(), new)]
        order = np.argsort(new[0])
        self.runs.append(tuple(x[order] for x in new))

    def _latin(self, texts: list[str]) -> list[bytes | None]:
        """Ids of each text; None where it holds a character that the array pass doesn't take."""
        joined = " ".join(texts) + "   "
        c = np.minimum(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), _WIDTH)
        kind, c = self.kinds[c], self.low[c]
        ends_at = np.cumsum([len(t) + 1 for t in texts])
        odd = set(np.searchsorted(ends_at, np.flatnonzero(kind == _odd), "right").tolist())
        inside = (kind != _space) & (kind != _odd)
        before = np.concatenate([[np.uint8(_space)], kind[:-1]])
        start = inside & ((kind != before) | (kind == _number))
        # 's 't 'm 'd and 're 've 'll, where the apostrophe begins a pre-token.
        a = np.flatnonzero((c[:-3] == 39) & start[:-3])
        x, y = c[a + 1], c[a + 2]
        short = a[np.isin(x, [115, 116, 109, 100])]
        long = a[((x == 114) & (y == 101)) | ((x == 118) & (y == 101)) | ((x == 108) & (y == 108))]
        start[short + 1] = start[long + 1] = False
        start[short + 2], start[long + 3] = inside[short + 2], inside[long + 3]
        was = np.concatenate([[False], inside[:-1]])
        begin, end = np.flatnonzero(start), np.flatnonzero(was & (start | ~inside))
        keys, first, where = np.unique(w64.span_hashes(c, begin, end), return_index=True, return_inverse=True)
        at, size = self._known(keys)
        new = np.flatnonzero(at < 0)
        if len(new):
            spans = zip(begin[first[new]].tolist(), end[first[new]].tolist())
            emptied = len(self.runs) and sum(len(r[0]) for r in self.runs) + len(new) > MEMORY
            if emptied:
                new, spans = np.arange(len(keys)), zip(begin[first].tolist(), end[first].tolist())
            self._remember(keys[new], [joined[i:j].lower() for i, j in spans])
            at, size = self._known(keys)
        count = size[where]
        stop = np.cumsum(count)
        ids = self.flat[np.repeat(at[where] - stop + count, count) + np.arange(stop[-1] if len(stop) else 0)]
        cuts = np.concatenate([[0], stop])[np.concatenate([[0], np.searchsorted(begin, ends_at)])].tolist()
        raw = ids.tobytes()
        return [None if i in odd else raw[4 * cuts[i]:4 * cuts[i + 1]] for i in range(len(texts))]

    def _ids(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words."""
        single: list[tuple[str, str, str]] = []
        cut: list[tuple[str, list[str]]] = []
        odd: list[str] = []
        for w in words:
            if not (w.isascii() or _PLAIN.fullmatch(w)):
                odd.append(w)
            elif w.isalpha():
                single.append((w, w.lower(), ""))
            elif (core := w.rstrip(_ENDS)).isalpha():
                single.append((w, core.lower(), w[len(core):]))
            elif _PLAIN.fullmatch(w) and not self.special.search(w):
                cut.append((w, _PARTS.findall(w.lower())))
            else:
                odd.append(w)
        known = self.parts
        unknown = {p for _, p, _ in single if p not in known}
        unknown.update(e for _, _, e in single if e and e not in known)
        unknown.update(p for _, ps in cut for p in ps if p not in known)
        if len(known) + len(unknown) > MEMORY:
            known = self.parts = {}
            unknown = {p for _, p, e in single for p in (p, e) if p}
            unknown.update(p for _, ps in cut for p in ps)
        fresh = list(unknown)
        groups = [fresh[i:i + 512] for i in range(0, len(fresh), 512)]
        for some, told in zip(groups, self.bare.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(told.ids, dtype="<u4")
            ends = (4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()
            raw, begin = ids.tobytes(), 0
            for p, end in zip(some, ends, strict=True):
                known[p] = raw[begin:end]
                begin = end
        out = {w: known[p] + known[e] if e else known[p] for w, p, e in single}
        for w, ps in cut:
            out[w] = b"".join(map(known.__getitem__, ps))
        for w, e in zip(odd, self.whole.encode_batch_fast(odd, add_special_tokens=False)):
            out[w] = np.array(e.ids, dtype="<u4").tobytes()
        return out

    def _by_word(self, texts: list[str]) -> list[bytes]:
        split = [None if _CONTROL.search(t) else t.split() for t in texts]
        ids = self._ids(list(set().union(*(s for s in split if s))))
        return [b"".join(map(ids.__getitem__, s)) if s is not None else
                np.array(self.whole.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()
                for s, t in zip(split, texts)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; a null text has none."""
        whole = [t or "" for t in texts]
        out: list[bytes | None] = [None] * len(whole)
        clean = [i for i, t in enumerate(whole) if not self.special.search(t)]
        for part in w64.blocks([whole[i] for i in clean], _BLOCK):
            for i, ids in zip(clean[part], self._latin([whole[i] for i in clean[part]])):
                out[i] = ids
        rest = [i for i, ids in enumerate(out) if ids is None]
        if rest:
            for i, ids in zip(rest, self._by_word([whole[i] for i in rest])):
                out[i] = ids
        return out


_known: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One per worker process and file."""
    if path not in _known:
        _known[path] = WordEncoder(path)
    return _known[path]
