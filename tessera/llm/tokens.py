"""Token ids through the tokenizers library, with a bounded memo of the ids of words."""

from __future__ import annotations

import re
import zlib
from functools import lru_cache
from itertools import chain, repeat
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Letters of which every Unicode version has the same (Latin, Greek, Cyrillic), and signs that are neither
#: letters nor numbers nor white space. Texts of these alone are cut by the standard re module as by the public pattern.
LETTER = "A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-ώЀ-ҁ"
SIGN = "!-/:-@\\[-`{-~¡-©«-±´¶-¸»¿×÷‐-‧€"
SIMPLE = re.compile(rf"[\t\n\r 0-9{LETTER}{SIGN}]*")
#: Fixed value: the public byte-level pre-token pattern for such texts.
SPLIT = re.compile(rf"'(?:[sdmt]|ll|ve|re)| ?[{LETTER}]+| ?[0-9]+| ?[^\s0-9{LETTER}]+|\s+(?!\S)|\s+")
#: A space is the beginning of a pre-token unless it stands so; one of these pairs must be there then.
INNER_SPACE = re.compile(r"\s \s|\s $")
PAIRS = ("  ", " \n", "\n ", " \t", "\t ", " \r", "\r ")
#: Where a comma or a full stop stands apart from other signs and spaces it is a pre-token of its own.
JOINED_STOP = re.compile(rf"[.,](?:(?<=[\s{SIGN}][.,])|[{SIGN}])")
#: Stands before the key of a text part without a space before it.
BARE = "\0"
#: Stands between the parts of all texts of a batch.
CUT = "\1"


#: The character that stands for each byte in the vocabulary of byte-level BPE.
SHOWN = [b for b in range(256) if chr(b).isprintable() and b != 0x20]
LEVEL = {b: chr(b) for b in SHOWN} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in SHOWN)}
SPACE = LEVEL[0x20]


def byte_level(pre: str) -> str:
    """A pre-token in the characters of its bytes; printable ASCII stands for itself."""
    if pre.isascii() and pre.isprintable() and not pre.isspace():
        return SPACE + pre[1:] if pre[0] == " " else pre
    return pre.encode().decode("latin-1").translate(LEVEL)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Memo(dict):
    """Slots of keys; a new key gets the next slot and waits for its ids."""

    def __init__(self) -> None:
        self.waiting: list[str] = []
        self.start, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.flat, self.used = np.zeros(1 << 14, np.uint32), 0

    def __missing__(self, key: str) -> int:
        self.waiting.append(key)
        slot = self[key] = len(self)
        return slot

    def slots(self, keys: list[str]) -> np.ndarray:
        """The slots of distinct keys."""
        out = np.fromiter(map(self.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(out < 0)
        out[new] = np.arange(len(self), len(self) + len(new))
        fresh = [keys[i] for i in new.tolist()]
        self.update(zip(fresh, out[new].tolist(), strict=True))
        self.waiting += fresh
        return out

    def fill(self, slots: list[int] | np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """The ids of slots: ``ids`` holds those of one slot after the other."""
        while len(self) > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[slots] = self.used + np.cumsum(sizes) - sizes
        self.size[slots] = sizes
        self.used += len(ids)

    def gathered(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of slots in a row, and how many are of each."""
        n = self.size[slots]
        first = np.cumsum(n) - n
        return self.flat[np.repeat(self.start[slots] - first, n) + np.arange(n.sum())], n


class Encoder:
    """Ids of texts, equal to Tokenizer.encode(text, add_special_tokens=False).ids.

    Byte-level BPE works on one pre-token at a time, and a space is the beginning of one, so a text is cut at its spaces
    and the ids of the parts are kept in a memo, which is asked once for each distinct part of a batch. New parts are cut into pre-tokens, which go to the model of the tokenizers
    library one by one: it takes them as they are, while a text would be cut by the pattern once more. A memo of ``limit`` parts becomes the older one, whose parts pass to the new one when they are met again;
    an older memo before it is forgotten. Texts with characters outside the plain set, or with the content of an
    added token, go to the library whole.
    """

    def __init__(self, path: str, limit: int = 300_000) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        added = [re.escape(t.content) for t in self.tok.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added)) if added else None
        self.memo, self.older, self.limit = Memo(), Memo(), limit
        self.merged = self.tok.model.tokenize

    def parts(self, text: str) -> str | None:
        """Keys of the parts of a text, with CUT between them; None where the library has to see it whole."""
        if not SIMPLE.fullmatch(text) or self.added and self.added.search(text):
            return None
        if any(p in text for p in PAIRS) and INNER_SPACE.search(text):
            return CUT.join(p[1:] if p[0] == " " else BARE + p for p in SPLIT.findall(text))
        out = text.replace(" ", CUT)
        if not JOINED_STOP.search(text):  # words then have one part, with or without a stop after them
            out = out.replace(".", f"{CUT}{BARE}.").replace(",", f"{CUT}{BARE},")
        return BARE + out

    def batch(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts (null: empty), each followed by ``end_id``, in a row, and how many are of each text."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        end = f"{BARE}{BARE}{end_id}"
        parts = [self.parts(t) if t else "" for t in texts]
        whole = [i for i, p in enumerate(parts) if p is None]
        every = pc.split_pattern(pa.array([CUT.join(chain.from_iterable((p, end) if p else (end,) for p in parts))], pa.large_string()), CUT).values.dictionary_encode()
        keys, place = every.dictionary.to_numpy(zero_copy_only=False).tolist(), every.indices.to_numpy()
        lengths = np.diff(np.flatnonzero(place == keys.index(end)), prepend=-1)
        slots = self.memo.slots(keys)[place]
        self.learn()
        ids, n = self.memo.gathered(slots)
        upto = np.concatenate([[0], np.cumsum(n)])[np.cumsum(lengths)]
        sizes = np.diff(upto, prepend=0)
        if whole:
            found = {i: np.array(e.ids, np.uint32) for i, e in zip(whole, self.tok.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False), strict=True)}
            ids = np.concatenate([x for i, (s, e) in enumerate(zip(upto - sizes, upto, strict=True)) for x in (found.get(i, ids[:0]), ids[s:e])])
            sizes[whole] += [len(found[i]) for i in whole]
        if len(self.memo) > self.limit:
            self.memo, self.older = Memo(), self.memo
        return ids, sizes

    def ids(self, text: str | None, end_id: int) -> np.ndarray:
        """The ids of a text (null: empty) and ``end_id``, as unsigned 32-bit integers."""
        return self.batch([text], end_id)[0]

    def learn(self) -> None:
        """Finds the ids of the parts that wait: in the older memo, or from their pre-tokens."""
        memo, older, waiting = self.memo, self.older, self.memo.waiting
        several: list[tuple[int, list[int]]] = []
        alone: list[int] = []
        words: list[str] = []
        begin = done = len(memo) - len(waiting)
        while done < len(memo):  # grows as pre-tokens of parts are met
            keys = waiting[done - begin :]
            at = np.fromiter(map(older.get, keys, repeat(-1)), np.int64, len(keys))
            known = np.flatnonzero(at >= 0)
            if len(known):
                memo.fill(done + known, *older.gathered(at[known]))
            for i in np.flatnonzero(at < 0).tolist():
                key = keys[i]
                if key.isalpha():
                    alone.append(done + i)
                    words.append(SPACE + (key if key.isascii() else byte_level(key)))
                elif key.startswith(BARE * 2):
                    memo.fill([done + i], np.array([int(key[2:])], np.uint32), np.ones(1, np.int64))
                else:
                    pre = SPLIT.findall(key[1:] if key[:1] == BARE else " " + key)
                    if len(pre) == 1:
                        alone.append(done + i)
                        words.append(byte_level(pre[0]))
                    else:
                        several.append((done + i, [memo[p[1:] if p[0] == " " and len(p) > 1 else BARE + p] for p in pre]))
            done += len(keys)
        for i in range(0, len(alone), 5_000):
            tokens = list(map(self.merged, words[i : i + 5_000]))
            sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
            memo.fill(alone[i : i + 5_000], np.fromiter(map(attrgetter("id"), chain.from_iterable(tokens)), np.uint32, int(sizes.sum())), sizes)
        if several:
            of = np.array([len(p) for _, p in several])
            ids, n = memo.gathered(np.array([s for _, p in several for s in p], np.int64))
            upto = np.concatenate([[0], np.cumsum(n)])[np.cumsum(of)]
            memo.fill([s for s, _ in several], ids, np.diff(upto, prepend=0))
        waiting.clear()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(path)


def crc32_of(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())
