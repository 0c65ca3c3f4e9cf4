"""Token ids of many texts at once for word-level BPE tokenizers, with numpy.

A tokenizer of this kind lower-cases a text, cuts it into pieces (contractions,
runs of letters, single digits, runs of other characters), drops white space and
merges inside a piece only.  Here all pieces of a batch are cut by byte class,
each distinct piece is merged once - all pieces together, one merge of each per
round, always the pair of lowest rank and of these the leftmost - and the ids
are laid out in the order of the pieces.  Vocabulary and merges come from the
tokenizer's own file.  Texts beyond plain Latin, and tokenizers of any other
kind, are encoded by the tokenizer itself.
"""

from __future__ import annotations

import json
import re

import numpy as np

from tickspark.llm.common import mix, ranges_concat

#: Any character outside printable ASCII, tab to carriage return and Latin letters: in texts without one,
#: lower-casing goes letter by letter and composition (NFC) changes nothing.
NOT_PLAIN = re.compile("[^\t-\r -~À-ÖØ-öø-þ]")
# Fixed value: the cut this module stands for, as tokenizer files state it.
CUT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
SPACE, LETTER, DIGIT, OTHER = range(4)
NO_PAIR = np.int32(2 ** 31 - 1)
#: Distinct pieces a task remembers.
REMEMBERED = 400_000


class Merges:
    """Ranks and results of the merges, in an open-addressing table."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.width = max(vocabulary.values()) + 1
        keys = np.array([vocabulary[a] * self.width + vocabulary[b] for a, b in pairs], np.int64)
        self.result = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        bits = max(4, int(len(keys) * 8).bit_length())
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NO_PAIR, np.int32)
        todo = np.arange(len(keys))
        slot = self._slot(keys)
        while len(todo):  # first come first served; the others try the next slot
            at = slot[todo]
            free = self.keys[at] == -1
            winners = todo[free][np.unique(at[free], return_index=True)[1]]
            self.keys[slot[winners]] = keys[winners]
            self.ranks[slot[winners]] = winners
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.view(np.uint64)) & np.uint64(self.mask)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.width + right
        slot = self._slot(key)
        out = np.full(len(key), NO_PAIR, np.int32)
        found = self.keys[slot]
        out[found == key] = self.ranks[slot[found == key]]
        open_ = np.flatnonzero((found != key) & (found != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            found = self.keys[slot[open_]]
            hit = found == key[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out

    def apply(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge pieces given as symbols and piece sizes; (symbols, sizes) afterwards, pieces in order."""
        piece = np.repeat(np.arange(len(sizes)), sizes)
        rank = np.full(len(symbols), NO_PAIR, np.int32)
        inner = np.flatnonzero(piece[:-1] == piece[1:])
        rank[inner] = self.rank(symbols[inner], symbols[inner + 1])
        done_symbols, done_piece = [], []
        while len(symbols):
            starts = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            counts = np.diff(np.append(starts, len(piece)))
            best = np.repeat(np.minimum.reduceat(rank, starts), counts)
            settled = best == NO_PAIR
            if settled.any():
                done_symbols.append(symbols[settled])
                done_piece.append(piece[settled])
                going = ~settled
                symbols, piece, rank, best = symbols[going], piece[going], rank[going], best[going]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == best)
            at = at[np.append(True, piece[at[1:]] != piece[at[:-1]])]  # the leftmost of each piece
            symbols[at] = self.result[rank[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            at = at - np.arange(len(at))  # one symbol fewer per piece before
            symbols, piece, rank = symbols[stay], piece[stay], rank[stay]
            for left in (at, at - 1):
                left = left[left >= 0]
                rank[left] = NO_PAIR
                left = left[left + 1 < len(piece)]
                left = left[piece[left] == piece[left + 1]]
                rank[left] = self.rank(symbols[left], symbols[left + 1])
        owner = np.concatenate(done_piece) if done_piece else piece
        order = np.argsort(owner, kind="stable")
        flat = np.concatenate(done_symbols) if done_symbols else symbols
        return flat[order], np.bincount(owner, minlength=len(sizes))


class WordBpe:
    """Encodes batches of texts as the tokenizer of ``path`` does.

    The tokenizer takes the strings of its added tokens as those tokens; texts that
    hold one (before or after lower-casing) are left to it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        config = json.loads(self.tokenizer.to_str())
        model = config["model"]
        steps = (config["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        forms = [n["type"] for n in (config["normalizer"] or {}).get("normalizers", [])]
        self.whole = not (steps[0].get("pattern") == {"Regex": CUT} and [s["type"] for s in steps[1:]] == ["ByteLevel"]
                          and forms == ["NFC", "Replace", "Lowercase"] and model["type"] == "BPE"
                          and model.get("end_of_word_suffix") == "</w>" and not model.get("continuing_subword_prefix"))
        if self.whole:
            return
        added = {t["content"] for t in config.get("added_tokens") or []}
        self.added = re.compile("|".join(re.escape(a) for a in sorted({a.lower() for a in added})) or "(?!)")
        vocabulary = model["vocab"]
        self.merges = Merges(vocabulary, model["merges"])
        # byte-level vocabularies write printable bytes as themselves and the others as 256, 257, ...
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = iter(range(256, 512))
        chars = [chr(b) if b in printable else chr(next(others)) for b in range(256)]
        self.inner = np.array([vocabulary[c] for c in chars], np.int32)
        self.final = np.array([vocabulary[c + "</w>"] for c in chars], np.int32)
        self.classes = np.full(256, OTHER, np.int8)
        self.classes[[9, 10, 11, 12, 13, 32]] = SPACE
        self.classes[ord("a"): ord("z") + 1] = LETTER
        self.classes[128:] = LETTER
        self.classes[ord("0"): ord("9") + 1] = DIGIT
        self.byte_code = mix(np.arange(1, 257, dtype=np.uint64))
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.store = np.zeros(0, np.int32)

    def _cut(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first byte, size) of every piece of lower-cased UTF-8 bytes."""
        kind = self.classes[text]
        begins = kind != SPACE
        begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        # a contraction: an apostrophe that begins a piece, and the letters that belong to it
        quote = np.flatnonzero(begins & (text == ord("'")))
        if len(quote):
            after = np.concatenate([text, np.zeros(2, np.uint8)])
            one, two = after[quote + 1], after[quote + 2]
            letters = np.isin(one, np.frombuffer(b"stmd", np.uint8)).astype(np.int64)
            for pair in (b"re", b"ve", b"ll"):
                letters[(one == pair[0]) & (two == pair[1])] = 2
            quote, letters = quote[letters > 0], letters[letters > 0]
            begins[quote + 1] = False
            rest = quote + 1 + letters
            rest = rest[rest < len(text)]
            begins[rest[kind[rest] == LETTER]] = True
        first = np.flatnonzero(begins)
        # a piece ends where the next begins or a blank stands
        stops = np.flatnonzero(begins[1:] | ((kind[1:] == SPACE) & (kind[:-1] != SPACE))) + 1
        ends = np.append(stops, len(text))[np.searchsorted(stops, first, "right")] if len(first) else first
        return first, ends - first

    def _ids(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first byte of each piece, number of ids of each, all ids)."""
        first, size = self._cut(text)
        if not len(first):
            return first, size, np.zeros(0, np.int32)
        place = ranges_concat(np.zeros(len(first), np.int64), size)
        power = np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64)
        power[0] = 1
        power = np.cumprod(power)
        inside = self.byte_code[text[ranges_concat(first, size)]] * power[place]
        codes = mix(np.add.reduceat(inside, np.cumsum(size) - size) + size.astype(np.uint64))
        kinds, example, which = np.unique(codes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, kinds)
        seen = np.zeros(len(kinds), bool)
        inner = at < len(self.known)
        seen[inner] = self.known[at[inner]] == kinds[inner]
        new = np.flatnonzero(~seen)
        if len(new):
            take = example[new]
            bytes_ = text[ranges_concat(first[take], size[take])]
            symbols = self.inner[bytes_]
            last = np.cumsum(size[take]) - 1
            symbols[last] = self.final[bytes_[last]]
            merged, sizes = self.merges.apply(symbols, size[take])
            starts = len(self.store) + np.cumsum(sizes) - sizes
            self.store = np.concatenate([self.store, merged])
            known = np.concatenate([self.known, kinds[new]])
            order = np.argsort(known, kind="stable")
            self.known = known[order]
            self.first = np.concatenate([self.first, starts])[order]
            self.size = np.concatenate([self.size, sizes])[order]
            at = np.searchsorted(self.known, kinds)
        counts = self.size[at][which]
        return first, counts, self.store[ranges_concat(self.first[at][which], counts)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids (uint32) of each text."""
        out: list = [None] * len(texts)
        lower = [] if self.whole else [(i, t.lower()) for i, t in enumerate(texts) if not NOT_PLAIN.search(t)]
        lower = [(i, t) for i, t in lower if not self.added.search(t)]
        plain = [i for i, _ in lower]
        if plain:
            if len(self.known) > REMEMBERED:
                self.forget()
            lowered = [t.encode() for _, t in lower]
            text = np.frombuffer(b"\n".join(lowered) + b"\n", np.uint8)
            ends = np.cumsum([len(t) + 1 for t in lowered])
            first, counts, ids = self._ids(text)
            # ids before each text's end
            upto = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(first, ends)]
            ids = ids.astype("<u4")
            for i, lo, hi in zip(plain, np.concatenate([[0], upto[:-1]]), upto):
                out[i] = ids[lo:hi]
        for i, t in enumerate(texts):
            if out[i] is None:
                out[i] = np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4")
        return out
