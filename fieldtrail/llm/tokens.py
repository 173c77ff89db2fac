"""Token ids of whole texts by a tokenizer file, with a cache of ids per distinct word.

Where the file splits texts into runs of letters, single digits and runs of other characters
before its merges (``_SPLIT``), a text's ids are those of its runs, one after the other. Each worker
keeps the ids of runs it has seen (up to ``CACHE_RUNS``; later ones are computed each time). Texts
with anything the byte classes below do not decide alike (apostrophes, other scripts or white
space, special-token strings) and files of another kind go through the tokenizer whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from fieldtrail.llm.words import RUNS, Words

CACHE_RUNS = 300_000
#: The split rule of the files that runs are valid for.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Anything but ASCII without the apostrophe, and the letters from U+00C0 to U+024F.
_ODD = re.compile("[^\t\n\r\x20-&(-~À-ÖØ-öø-ɏ]|<\\|")


def splits_into_runs(path: str) -> bool:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    split = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    return (
        (split[0].get("pattern") or {}).get("Regex") == _SPLIT
        and steps == ["NFC", "Replace", "Lowercase"]
        and [s.get("type") for s in split[1:]] == ["ByteLevel"]
        and spec.get("post_processor") is None
    )


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Ids of texts; one per worker process and file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.runs = splits_into_runs(path)
        self.known: dict[int, int] = {}
        self.flat, self.used = np.zeros(1 << 20, np.uint32), 0
        self.begin, self.size = np.zeros(CACHE_RUNS, np.int64), np.zeros(CACHE_RUNS, np.int64)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text."""
        strings = [t.decode("utf-8", "replace") for t in texts]
        plain = [self.runs and not _ODD.search(s) for s in strings]
        words = Words([t if p else b"" for t, p in zip(texts, plain)], RUNS)
        ids, ends = self._of_runs(words)
        return [ids[a:b] if p else self.whole(s) for s, p, a, b in zip(strings, plain, ends[:-1], ends[1:])]

    def _of_run(self, run: bytes) -> list[int]:
        text = run.decode().lower().encode().decode("latin-1").translate(self.letters)
        return [token.id for token in self.model.tokenize(text)]

    def _of_runs(self, words: Words) -> tuple[np.ndarray, list[int]]:
        distinct, first, where = np.unique(words.hash, return_index=True, return_inverse=True)
        at = np.fromiter((self.known.get(h, -1) for h in distinct.tolist()), np.int64, len(distinct))
        new = np.flatnonzero(at < 0)
        data = words.buf.tobytes()
        spans = zip(words.start[first[new]].tolist(), words.end[first[new]].tolist())
        lists = [self._of_run(data[a:b]) for a, b in spans]
        fresh_size = np.fromiter(map(len, lists), np.int64, len(lists))
        fresh = np.fromiter((i for ids in lists for i in ids), np.uint32, int(fresh_size.sum()))
        begin, size = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        old = at >= 0
        begin[old], size[old] = self.begin[at[old]], self.size[at[old]]
        begin[new], size[new] = self.used + np.cumsum(fresh_size) - fresh_size, fresh_size
        pool = np.concatenate([self.flat[: self.used], fresh])
        count = size[where]
        ends = np.concatenate([[0], np.cumsum(count)])
        ids = pool[np.repeat(begin[where] - ends[:-1], count) + np.arange(ends[-1])] if len(count) else fresh
        self._keep(distinct, new, begin, fresh, fresh_size)
        return ids, ends[words.first].tolist()

    def _keep(self, distinct, new, begin, fresh, fresh_size) -> None:
        n = len(self.known)
        room = min(len(new), CACHE_RUNS - n)
        if not room:
            return
        kept = int(fresh_size[:room].sum())
        self.begin[n : n + room], self.size[n : n + room] = begin[new[:room]], fresh_size[:room]
        self.known.update(zip(distinct[new[:room]].tolist(), range(n, n + room)))
        if self.used + kept > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(max(len(self.flat), kept), np.uint32)])
        self.flat[self.used : self.used + kept] = fresh[:kept]
        self.used += kept


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
