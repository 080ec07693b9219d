"""Tokenizing with the tokenizers library, each different chunk of text once."""

from __future__ import annotations

import os
from functools import lru_cache


_PUNCTUATION = ".,;:!?*#%&$()[]{}\"-_/+="

#: How byte-level vocabularies write a space. A fixed value.
_SPACE = "\u0120"


class Encoder:
    """Encodes texts to little-endian unsigned ids, exactly as the tokenizer would encode the whole text.

    Texts are cut where no token can reach across, and the ids of each chunk are kept, as most
    chunks recur. ``cut`` says where that is safe:

    * ``"space"`` (byte-level BPE, where a word's token begins with the space before it): before
      single spaces and around single newlines. A text with other white space, or with two white
      characters in a row, is encoded as a whole.
    * ``"white"`` (vocabularies that drop white space and case): at white space.
    * ``None``: each text is encoded as a whole.

    New chunks are encoded many at once, with the vocabulary's special token between them; in both
    kinds of vocabulary, punctuation after a word's last letter or digit is a token of its own, and
    words of ASCII letters go to the bare model. At most
    ``most`` chunks are kept, then all but those of the texts at hand are forgotten.
    """

    def __init__(self, path: str, cut: str | None, most: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.joined = Tokenizer.from_file(path)
        self.mark = next((x.content for x in self.joined.get_added_tokens_decoder().values() if x.special), None)
        self.size = self.tokenizer.get_vocab_size()
        self._plain_words(path, cut)
        self.dtype = "<u2" if self.size <= 1 << 16 else "<u4"
        self.cut, self.most, self.kept = cut, most, {}

    def _plain_words(self, path: str, cut: str | None) -> None:
        """For words of ASCII letters: the bare model, as nothing else would change or cut them.

        ``at_edge`` tells by which ids a word ends ("white") or begins ("space").
        """
        import numpy as np
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        self.at_edge = np.zeros(self.size, bool)
        for x, i in self.bare.get_vocab().items():
            self.at_edge[i] = x.endswith("</w>") if cut == "white" else x.startswith(_SPACE)

    def _encode_plain(self, chunks: list[str]) -> None:
        import numpy as np

        wide, first = np.dtype(self.dtype).itemsize, self.cut == "space"
        groups = [chunks[i : i + 256] for i in range(0, len(chunks), 256)]
        texts = ["\n".join(x).replace(" ", _SPACE) for x in groups]
        for group, found in zip(groups, self.bare.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, dtype=self.dtype)
            edges = (np.flatnonzero(self.at_edge[ids]) + (not first)) * wide
            raw = ids.tobytes()
            ends = [*edges[1:].tolist(), len(raw)] if first else edges.tolist()
            if len(ends) != len(group):
                raise AssertionError("a word was not encoded by itself")
            self.kept.update(zip(group, [raw[begin:end] for begin, end in zip([0, *ends], ends)]))

    def _ids(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=self.dtype).tobytes() for x in found]

    def _add(self, chunks: list[str]) -> None:
        """Keeps the ids of new chunks: of those that are a word and ASCII punctuation, from the ids of both."""
        kept, plain, parts, again, fold = self.kept, set(), set(), [], self.cut == "white"
        add, keep, bare = parts.add, again.append, (plain if self.at_edge.any() else parts).add
        for x, word in zip(chunks, [x.rstrip(_PUNCTUATION) for x in chunks]):
            tail = None
            if word != x:
                if (end := word[-1:]).isalnum() and (end < "\x80" or end.lower()[-1].isalnum()):
                    tail = x[len(word) :]
                    add(tail)
                else:
                    word = x
            if not word.isascii():
                add(word)
            elif fold:
                word = word.lower()
                (bare if word.isalpha() else add)(word)
            else:
                (bare if word[:1] == " " and word[1:].isalpha() else add)(word)
            if tail is not None or word != x:
                keep((x, word, tail))
        if plain:
            self._encode_plain([x for x in plain if x not in kept])
        self._encode([x for x in parts if x not in kept])
        for x, word, tail in again:
            kept[x] = kept[word] if tail is None else kept[word] + kept[tail]

    def _encode(self, chunks: list[str]) -> None:
        """Keeps the ids of chunks, encoded many at once."""
        import numpy as np

        mark = self.mark
        if mark is None or mark[:2] in "\n".join(chunks):
            odd = chunks if mark is None else [x for x in chunks if mark[0] in x or x[-1:] == mark[0]]
            self.kept.update(zip(odd, self._ids(odd)))
            chunks = [x for x in chunks if x not in self.kept]
        if not chunks:
            return
        wide, between = np.dtype(self.dtype).itemsize, self.joined.token_to_id(mark)
        groups = [chunks[i : i + 256] for i in range(0, len(chunks), 256)]
        for group, found in zip(groups, self.joined.encode_batch_fast([mark.join(x) for x in groups], add_special_tokens=False)):
            ids = np.array(found.ids, dtype=self.dtype)
            ends = (np.flatnonzero(ids == between) * wide).tolist()
            raw = ids.tobytes()
            begins = [0, *(x + wide for x in ends)]
            ends.append(len(raw))
            if len(begins) != len(group):
                raise AssertionError("a chunk was not encoded by itself")
            self.kept.update(zip(group, [raw[begin:end] for begin, end in zip(begins, ends)]))

    def _chunks(self, texts: list[str]):
        """Which texts are cut, and their chunks, a list for each of those."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if self.cut == "white":
            fit = [i for i, x in enumerate(texts) if not any(c in x for c in "\x1c\x1d\x1e\x1f")]
            return fit, pc.utf8_split_whitespace(pa.array([texts[i] for i in fit], pa.large_string()))
        fit = [i for i, x in enumerate(texts) if x and "\x00" not in x] if self.cut else []
        own = pa.array([texts[i] for i in fit], pa.large_string())
        if fit:
            words = pc.utf8_split_whitespace(own)
            letters = pc.binary_length(words.flatten()).to_numpy()
            begins = words.offsets.to_numpy()[:-1]
            gaps = np.add.reduceat(letters > 0, begins, dtype=np.int64) - 1
            single = pc.add(pc.count_substring(own, " "), pc.count_substring(own, "\n")).to_numpy() == gaps
            single &= pc.binary_length(own).to_numpy() - np.add.reduceat(letters, begins) == gaps
            fit, own = [fit[i] for i in np.flatnonzero(single).tolist()], own.filter(pa.array(single))
        marked = pc.replace_substring(pc.replace_substring(own, " ", "\x00 "), "\n", "\x00\n\x00")
        return fit, pc.split_pattern(marked, "\x00")

    def __call__(self, texts: list[str]) -> list[bytes]:
        import pyarrow as pa

        fit, chunks = self._chunks(texts)
        coded = chunks.flatten().dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.kept.get, names))
        if len(self.kept) > self.most:
            self.kept = {x: ids for x, ids in zip(names, found) if ids is not None}
        if None in found:
            new = [i for i, ids in enumerate(found) if ids is None]
            self._add([names[i] for i in new])
            for i in new:
                found[i] = self.kept[names[i]]
        own = pa.array(found, pa.large_binary()).take(coded.indices)
        ends = pa.Array.from_buffers(pa.int64(), len(own) + 1, [None, own.buffers()[1]]).take(chunks.offsets).to_pylist()
        raw = memoryview(own.buffers()[2] or b"")
        out = [b""] * len(texts)
        for i, begin, end in zip(fit, ends, ends[1:]):
            out[i] = raw[begin:end].tobytes()
        whole = sorted(set(range(len(texts))).difference(fit))
        if whole:
            for i, ids in zip(whole, self._ids([texts[i] for i in whole])):
                out[i] = ids
        return out


@lru_cache(maxsize=4)
def encoder(path: str, cut: str | None) -> Encoder:
    """One for each worker process, which keeps its chunks from task to task."""
    return Encoder(path, cut)
