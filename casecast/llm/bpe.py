"""Byte pair encoding of very long texts and words, in memory that does not grow with what the merges look at."""

import re
import sys
import types

import numpy as np
import tiktoken

#: Code points that are encoded at a time, and bytes of one word that are merged at a time where it can be cut.
CHUNK, WINDOW = 1 << 18, 1 << 16

# Places where words of these vocabularies always end: after an ASCII letter or digit before another kind of ASCII
# character, and after any ASCII mark before a space or line feed. `|` is left out, as special tokens end in it.
BOUNDARY = re.compile(
    r"(?<=[A-Za-z])(?=[\n !-/0-9:-@\[-`{}~])|(?<=[0-9])(?=[\n !-/A-Za-z:-@\[-`{}~])|(?<=[!-/:-@\[-`{-~])(?=[\n ])"
)


def per_worker(key, make):
    """`make()` once in a Python process. Functions travel to workers by value, so their module's globals are new in
    every task; what is kept in `sys.modules` stays."""
    kept = sys.modules.setdefault("casecast_kept_by_worker", types.ModuleType("casecast_kept_by_worker"))
    if key not in kept.__dict__:
        setattr(kept, key, make())
    return getattr(kept, key)


def chunks(text, size):
    """`text` in pieces that end where a word always ends, of about `size` code points where there is such a place."""
    at = 0
    while at < len(text):
        met = BOUNDARY.search(text, at + size)
        end = met.start() if met else len(text)
        yield text[at:end]
        at = end


def bytes_of_characters():
    """The byte that each character of a byte-level vocabulary file stands for: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(rest)}


class Words:
    """Ids of single words of any length, from a vocabulary whose merges come in the order of their ids.

    `ranks` has the id of each token by its bytes. A word is cut between bytes that no token holds side by side, which
    no merge can span; windows without such a place, like a run of one character, are merged in arrays, one kind of
    pair in all places at a time.
    """

    def __init__(self, ranks):
        self.ranks = ranks
        self.whole = tiktoken.Encoding("word", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        self.beside = np.zeros((256, 256), bool)
        for token in ranks:
            for a, b in zip(token, token[1:]):
                self.beside[a, b] = True
        self.beside[:, 0x80:0xC0] = True  # a cut is also one between characters
        self.singles = np.array([ranks[bytes([byte])] for byte in range(256)], np.int32)
        self.made = None

    def _pairs(self):
        """Each pair of ids that merges, as one sorted number, and the id it merges to."""
        if self.made is None:
            found = {}
            for token, rank in self.ranks.items():
                for cut in range(1, len(token)):
                    a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                    if a is not None and b is not None:
                        found[a << 20 | b] = rank
            keys = np.array(sorted(found), np.int64)
            self.made = keys, np.array([found[k] for k in keys.tolist()], np.int64)
        return self.made

    def _next_merge(self, ids):
        keys, made = self._pairs()
        least, pair = None, None
        for at in range(0, len(ids) - 1, 1 << 20):
            own = ids[at : at + (1 << 20) + 1].astype(np.int64)
            met = np.unique(own[:-1] << 20 | own[1:])
            place = np.minimum(np.searchsorted(keys, met), len(keys) - 1)
            good = keys[place] == met
            if good.any():
                best = np.argmin(np.where(good, made[place], np.iinfo(np.int64).max))
                if least is None or made[place[best]] < least:
                    least, pair = int(made[place[best]]), int(met[best])
        return least, pair

    def _merge(self, data):
        ids = self.singles[np.frombuffer(data, np.uint8)]
        while len(ids) > 1:
            new, pair = self._next_merge(ids)
            if new is None:
                break
            a, b = pair >> 20, pair & (1 << 20) - 1
            hit = (ids[:-1] == a) & (ids[1:] == b)
            if a == b:  # in a run of hits every other one
                place = np.arange(len(hit), dtype=np.int32)
                first = hit.copy()
                first[1:] &= ~hit[:-1]
                begun = np.maximum.accumulate(np.where(first, place, np.int32(0)))
                hit &= (place - begun) % 2 == 0
                del place, first, begun
            at = np.flatnonzero(hit)
            ids[at] = new
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids = ids[keep]
        return ids.astype(np.uint32)

    def encode(self, word):
        """The ids of one word given as a string, as a list of arrays."""
        data = word.encode()
        raw = np.frombuffer(data, np.uint8)
        found, at = [], 0
        while at < len(data):
            end = len(data)
            for near in range(at + WINDOW, len(data) - 1, WINDOW):
                last = min(near + WINDOW, len(data) - 1)
                free = np.flatnonzero(~self.beside[raw[near:last], raw[near + 1 : last + 1]])
                if len(free):
                    end = near + int(free[0]) + 1
                    break
            piece = data[at:end]
            if len(piece) <= 3 * WINDOW:
                found.append(np.array(self.whole.encode_ordinary(piece.decode()), np.uint32))
            else:
                found.append(self._merge(piece))
            at = end
        return found
