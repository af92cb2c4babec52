"""Token ids of texts by their pieces.

The tokenizer of word_bpe_49k.json turns white space into one space, never lets a token cross it and drops it,
and its special strings hold none: cutting a text at ASCII white space is safe, and a text's ids are those of
its pieces in order.  It also ends a token between a letter and a digit, and between either and punctuation, so
texts are cut there, too (see ``seams``): "word", "word," and "(word" need one entry.  Tokenizers of other rules
are given pieces between white space.

Pieces repeat, so each distinct one is encoded once per worker while the table of known pieces has room.  When it
is full, those met most often since stay, which bounds its memory.
"""

from __future__ import annotations

import json
import os

import numpy as np

from lumentab.llm.words import SPACED, Cut, held

TOKENIZER = "word_bpe_49k.json"
#: Kind under which a worker keeps its tables while it works on tokens.
KIND = "pieces"
#: Pieces held by a worker (some 35 bytes each), pieces joined into one text for the tokenizer, and bytes of a call.
KNOWN, JOINED, CALL_BYTES = 500_000, 256, 1 << 17

#: The rules for which ``seams`` holds: how a text is normalised, and what its words are.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORDS = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

#: Kinds of bytes.  White space, "|" (it stands in special strings) and parts of other characters are ``OTHER``.
OTHER, LETTER, DIGIT, MARK, QUOTE = range(5)
KINDS = np.full(256, OTHER, dtype=np.uint8)
KINDS[:128] = MARK
KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
KINDS[0x30:0x3A] = DIGIT
KINDS[ord("'")] = QUOTE
KINDS[[ord("|"), 0x20, *range(0x09, 0x0E)]] = OTHER
#: Whether a word ends between two kinds: a quote may begin a word with the letters behind it, and digits stand alone.
_ENDS = np.zeros((5, 5), dtype=bool)
for _left, _right in ((LETTER, DIGIT), (LETTER, MARK), (LETTER, QUOTE), (DIGIT, LETTER), (DIGIT, DIGIT), (DIGIT, MARK), (DIGIT, QUOTE),
                      (MARK, LETTER), (MARK, DIGIT), (QUOTE, DIGIT)):
    _ENDS[_left, _right] = True
ENDS = _ENDS.ravel()


def kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each byte; both bytes of the letters U+00C0 to U+00FF are letters."""
    out = KINDS[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    out[lead] = out[lead + 1] = LETTER
    return out


def seams(data: np.ndarray) -> np.ndarray:
    """Bytes before which a word ends whatever stands around.  Characters of these kinds never compose with the one before."""
    kind = kinds(data)
    out = np.zeros(len(data), dtype=bool)
    out[1:] = ENDS[kind[:-1] * np.uint8(5) + kind[1:]]
    return out


def _lined_up(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces of ``data``, each followed by a space; and the places behind these."""
    size = ends - starts + 1
    stops = np.cumsum(size)
    place = np.arange(int(size.sum())) + np.repeat(starts - (stops - size), size)
    out = data[np.minimum(place, len(data) - 1)]
    out[stops - 1] = 0x20
    return out, stops


def tokenizer_path(path: str | None = None) -> str:
    if path is not None:
        return path
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def has_seams(tokenizer) -> bool:
    """Whether the rules of a tokenizer end words at ``seams``, and its model marks the ends of words."""
    rules = [json.loads(part.__getstate__()) if part is not None else None for part in (tokenizer.normalizer, tokenizer.pre_tokenizer)]
    added = tokenizer.get_added_tokens_decoder().values()
    return rules == [NORMALIZER, WORDS] and bool(getattr(tokenizer.model, "end_of_word_suffix", None)) and not any(
        t.normalized or t.single_word or t.lstrip or t.rstrip or "|" not in t.content or seams(np.frombuffer(t.content.encode(), np.uint8)).any() for t in added)


class PieceTable:
    """Known pieces by ascending fingerprint: ``sizes`` tokens each, from ``starts`` in ``ids``; met again in ``hits`` blocks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.fine = has_seams(self.tokenizer)
        #: Whether a token ends a word.
        suffix = self.tokenizer.model.end_of_word_suffix if self.fine else None
        self.last = np.array([bool(suffix) and (self.tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(self.tokenizer.get_vocab_size())], dtype=bool)
        self.clear()

    @classmethod
    def of(cls, path: str | None) -> PieceTable:
        """The worker's table."""
        path = tokenizer_path(path)
        tables = held(KIND)
        if path not in tables:
            tables[path] = cls(path)
        return tables[path]

    def clear(self) -> None:
        self.marks = np.empty(0, np.uint64)
        self.sizes = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int32)
        self.hits = np.empty(0, np.uint32)
        self.ids = np.empty(0, np.uint32)

    def make_room(self, n: int) -> None:
        """Keep the pieces met most often, half of ``KNOWN`` at most, if ``n`` more would be too many."""
        if len(self.marks) + n <= KNOWN:
            return
        keep = np.flatnonzero(self.hits)
        most = max(min(KNOWN // 2, KNOWN - n), 0)
        if len(keep) > most:
            keep = np.sort(keep[np.argsort(self.hits[keep], kind="stable")[len(keep) - most:]])
        sizes = self.sizes[keep].astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        self.ids = self.ids[np.arange(int(sizes.sum())) + np.repeat(self.starts[keep] - starts, sizes)]
        self.marks, self.sizes, self.starts, self.hits = self.marks[keep], self.sizes[keep], starts.astype(np.int32), self.hits[keep] >> 1

    def _encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, words: bool) -> tuple[np.ndarray, np.ndarray]:
        """Tokens per piece, and all ids.  Pieces are joined with spaces.

        Pieces that are one word each (``words``) end with the tokens that end a word; of others, offsets tell whose a token is.
        """
        line, stops = _lined_up(data, starts, ends)
        sizes, ids = [np.empty(0, np.int64)], [np.empty(0, np.uint32)]
        lo = 0
        while lo < len(stops):
            call = []
            at = first = int(stops[lo - 1]) if lo else 0
            while lo < len(stops) and (not call or at - first < CALL_BYTES):
                own = stops[lo:lo + JOINED] - at
                call.append((line[at:at + own[-1]], own))
                lo, at = lo + len(own), at + int(own[-1])
            texts = [part.tobytes().decode() for part, _ in call]
            if words:
                got = [np.array(g.ids, dtype=np.uint32) for g in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
                stop = [np.flatnonzero(self.last[g]) + 1 for g in got]
                if all(len(s) == len(own) and s[-1] == len(g) for s, g, (_, own) in zip(stop, got, call, strict=True)):
                    sizes += [np.diff(s, prepend=0) for s in stop]
                    ids += got
                    continue
            for (part, own), one in zip(call, self.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
                # Offsets count code points.
                points = np.cumsum((part & 0xC0) != 0x80)[own - 1]
                at_points = np.array([o[0] for o in one.offsets], dtype=np.int64)
                sizes.append(np.bincount(np.searchsorted(points, at_points, side="right"), minlength=len(own)))
                ids.append(np.array(one.ids, dtype=np.uint32))
        return np.concatenate(sizes), np.concatenate(ids)

    def learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of new pieces, and where they stand in ``ids`` from now on."""
        line, stops = _lined_up(data, starts, ends)
        words = np.logical_and.reduceat((kinds(line) == LETTER) | (line == 0x20), np.concatenate(([0], stops[:-1]))) if self.fine else np.zeros(len(starts), bool)
        sizes, at = np.empty(len(starts), np.int64), np.empty(len(starts), np.int64)
        for of_words in (True, False):
            own = np.flatnonzero(words == of_words)
            if len(own):
                sizes[own], ids = self._encode(data, starts[own], ends[own], of_words)
                at[own] = len(self.ids) + np.cumsum(sizes[own]) - sizes[own]
                self.ids = np.concatenate((self.ids, ids))
        return sizes, at

    def cut(self, buf: np.ndarray, offsets: np.ndarray) -> Cut:
        return Cut(buf, offsets, SPACED, seams if self.fine else None)

    def slots(self, cut: Cut) -> np.ndarray:
        """The place of every piece of a block in the table."""
        marks, at, back = np.unique(cut.fingerprints(), return_index=True, return_inverse=True)
        self.make_room(len(marks))
        place = np.searchsorted(self.marks, marks)
        fresh = np.ones(len(marks), dtype=bool)
        inside = place < len(self.marks)
        fresh[inside] = self.marks[place[inside]] != marks[inside]
        self.hits[place[~fresh]] += 1
        if fresh.any():
            new = np.flatnonzero(fresh)
            sizes, starts = self.learn(cut.bytes, cut.starts[at[new]], cut.ends[at[new]])
            self.starts = np.insert(self.starts, place[new], starts)
            self.sizes = np.insert(self.sizes, place[new], sizes)
            self.hits = np.insert(self.hits, place[new], 0)
            self.marks = np.insert(self.marks, place[new], marks[new])
            place = place + np.cumsum(fresh) - fresh
        return place[back]

    def lengths(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text of a block."""
        cut = self.cut(buf, offsets)
        total = np.concatenate(([0], np.cumsum(self.sizes_of(self.slots(cut)))))
        return total[cut.first[1:]] - total[cut.first[:-1]]

    def sizes_of(self, slots: np.ndarray) -> np.ndarray:
        return self.sizes[slots] if len(slots) else np.empty(0, np.int32)

    def encode(self, buf: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a block's texts, each followed by ``end``; and their number per text."""
        cut = self.cut(buf, offsets)
        slots = self.slots(cut)
        size = self.sizes_of(slots)
        total = np.concatenate(([0], np.cumsum(size)))
        per_text = total[cut.first[1:]] - total[cut.first[:-1]] + 1
        out = np.full(int(per_text.sum()), end, dtype=np.uint32)
        # Each piece is moved on by the end ids of the texts before its own.
        target = total[:-1] + cut.row
        inner = np.arange(total[-1]) - np.repeat(total[:-1], size)
        out[inner + np.repeat(target, size)] = self.ids[inner + np.repeat(self.starts[slots], size)] if len(slots) else 0
        return out, per_text
