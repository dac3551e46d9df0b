"""Token ids of whole texts with a public word-level BPE tokenizer, by a bounded cache of white-space chunks.

The tokenizer drops white space and never joins what white space parts, so a
text's ids are the ids of its chunks in a row. Chunks that are a Latin word
with ASCII punctuation behind it are tokenised word by word in bulk: a word is
one pre-token, so its ids end at the first id that closes a word.
"""

from __future__ import annotations

import re
import sys
import types

#: Entries kept in a worker's cache (about 100 MB); beyond it the cache starts anew.
CACHE_LIMIT = 400_000
_CHUNKS = re.compile("[^ \t\n\r\x0b\x0c]+")
# Letters that lower-case one to one, and ASCII punctuation without '<' (special tokens) and the apostrophe.
_LATIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=-@\[-`{-~]*)")
_CONTROL = re.compile("[\x1c-\x1f]")


def chunks(text: str) -> list[str]:
    """Runs between white space; str.split() also parts at four control characters, which are no white space here."""
    return _CHUNKS.findall(text) if _CONTROL.search(text) else text.split()


def worker_store() -> dict:
    """A dict that lives as long as the Python worker (function globals are rebuilt for every task)."""
    return sys.modules.setdefault("vigilo_worker_store", types.ModuleType("vigilo_worker_store")).__dict__


class ChunkTokenizer:
    """``ids(texts)`` gives each text's ids as little-endian uint32 bytes."""

    def __init__(self, definition: str):
        import json

        import numpy as np
        from tokenizers import Tokenizer

        store = worker_store()
        key = hash(definition)
        if store.get("key") != key:
            suffix = json.loads(definition)["model"].get("end_of_word_suffix") or ""
            tok = Tokenizer.from_str(definition)
            vocab = tok.get_vocab()
            ends = np.zeros(max(vocab.values()) + 1, bool)
            ends[[i for w, i in vocab.items() if suffix and w.endswith(suffix)]] = True
            store.update(key=key, tok=tok, ends=ends, cache={}, words={})
        self.tok, self.ends, self.cache, self.words = store["tok"], store["ends"], store["cache"], store["words"]

    def _single(self, parts: list[str]) -> list[bytes]:
        import numpy as np

        return [np.array(q.ids, "<u4").tobytes() for q in self.tok.encode_batch_fast(parts, add_special_tokens=False)]

    def _learn_words(self, new: list[str]) -> None:
        import numpy as np

        for a in range(0, len(new), 2000):
            part = new[a:a + 2000]
            ids = np.array(self.tok.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part) and cuts[-1] == len(ids):
                raw, cuts = ids.tobytes(), [0, *(4 * cuts).tolist()]
                self.words.update(zip(part, (raw[s:e] for s, e in zip(cuts, cuts[1:]))))
            else:
                self.words.update(zip(part, self._single(part)))

    def _learn(self, new: list[str]) -> None:
        latin, rest = [], []
        for c in new:
            m = _LATIN.fullmatch(c)
            if m:
                latin.append((c, m[1].lower(), m[2]))
            else:
                rest.append(c)
        words, marks = self.words, {p for _, _, p in latin if p}
        rest += [p for p in marks if p not in self.cache]
        self.cache.update(zip(rest, self._single(rest)))
        self._learn_words(list({w for _, w, _ in latin if w not in words}))
        self.cache.update((c, words[w] + self.cache[p] if p else words[w]) for c, w, p in latin)

    def ids(self, texts) -> list[bytes]:
        if len(self.cache) > CACHE_LIMIT:  # only between calls: within one, what was learnt stays
            self.cache.clear()
        if len(self.words) > CACHE_LIMIT:
            self.words.clear()
        parted = [chunks(t or "") for t in texts]
        unknown = set().union(*parted).difference(self.cache)
        if unknown:
            self._learn(list(unknown))
        get = self.cache.__getitem__
        return [b"".join(map(get, p)) for p in parted]
