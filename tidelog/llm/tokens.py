"""Token ids of texts by a public tokenizer file, with a cache of pieces."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable

import numpy as np

#: Pieces in a worker's cache; when it is full, those not used lately go.
CACHE_PIECES = 600_000
#: Longer pieces are not kept.
CACHE_CHARS = 40

# How the file ``word_bpe_49k.json`` normalises and splits.
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

# The same split for lower-cased Latin-1, where NFC changes nothing.
_LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECES = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]|[^ \t-\r{_LETTERS}{_NUMBERS}]+")
#: Texts with a piece that has one of these go to the tokenizer whole.
_OTHER = re.compile(r"[^\t-\r\x20-\x7e\xa1-\xff]|<\|")


class PieceTokenizer:
    """Ids of whole texts, from the ids of their pieces where that is exact.

    For the tokenizer file named above, Latin-1 texts are lower-cased and split
    here, and each new piece goes through the file's model once; any other text,
    and any other file, goes through the tokenizer as it is.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.dtype = id_type(self.vocabulary)
        self.lately: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.by_piece = self._splits_as_known()
        if self.by_piece:
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = pre_tokenizers.Sequence(
                [
                    pre_tokenizers.WhitespaceSplit(),
                    pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
                ]
            )
            self.ends = np.zeros(self.vocabulary, bool)
            for token, i in self.tokenizer.get_vocab().items():
                self.ends[i] = token.endswith("</w>")

    def _splits_as_known(self) -> bool:
        spec = json.loads(self.tokenizer.to_str())
        normal, split = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        steps = [n["type"] for n in normal.get("normalizers", [])]
        patterns = [p["pattern"].get("Regex") for p in split.get("pretokenizers", []) if p["type"] == "Split"]
        kept = spec["model"].get("end_of_word_suffix") == "</w>" and not spec["model"].get("dropout")
        return steps == NORMALIZERS and patterns == [SPLIT] and kept

    def _whole(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in done]

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of new pieces, many in one call; each ends with a word end."""
        result = {}
        width = np.dtype(self.dtype).itemsize
        for first in range(0, len(pieces), 5000):
            some = pieces[first : first + 5000]
            ids = np.array(self.model.encode_batch_fast([" ".join(some)])[0].ids, self.dtype)
            cuts = ((np.flatnonzero(self.ends[ids]) + 1) * width).tolist()
            raw, at = ids.tobytes(), 0
            for piece, cut in zip(some, cuts, strict=True):
                result[piece] = raw[at:cut]
                at = cut
        return result

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text as little-endian bytes; null is empty."""
        texts = [t or "" for t in texts]
        if not self.by_piece:
            return self._whole(texts)
        pieces = [_PIECES.findall(t.lower()) for t in texts]
        lately, before = self.lately, self.before
        wanted = [p for p in set().union(*pieces) if p not in lately]
        again = {p: before[p] for p in wanted if p in before}
        fresh = [p for p in wanted if p not in again]
        odd = [p for p in fresh if _OTHER.search(p)]
        new = self._learn([p for p in fresh if not _OTHER.search(p)] if odd else fresh)
        lately.update(again)
        lately.update(new)
        lately.update(dict.fromkeys(odd))
        result: list[bytes | None] = []
        for found in pieces:
            try:
                result.append(b"".join(map(lately.__getitem__, found)))
            except TypeError:  # an odd piece has no ids
                result.append(None)
        whole = [i for i, ids in enumerate(result) if ids is None]
        for i, ids in zip(whole, self._whole([texts[i] for i in whole]), strict=True):
            result[i] = ids
        for p in [p for p in fresh if len(p) > CACHE_CHARS]:
            del lately[p]
        if len(lately) > CACHE_PIECES:
            self.before, self.lately = lately, {}
        return result


def id_type(vocabulary: int) -> str:
    """Bytes of a stored id: two where every id fits."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


_LOADED: dict[str, PieceTokenizer] = {}


def load(path: str) -> PieceTokenizer:
    """The tokenizer of this worker process."""
    if path not in _LOADED:
        _LOADED[path] = PieceTokenizer(path)
    return _LOADED[path]
