"""Token ids of a word-end vocabulary of the tokenizers library, with frequent words remembered."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np

from tallybrook.llm.memory import RunMemory, grouped, joined_units, per_text, short_names

#: How such vocabularies split a text: contractions, runs of letters, single digits, runs of other marks.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Texts with anything else than common Latin characters, or with what may be a special token, go to the library as they are.
_RARE = re.compile("[^\t-\r\x20-\x7e\xa1-įĲ-ɏ]")
_SPECIAL = "<|"
#: The library's characters for bytes that have none of their own.
_BYTES = {b: 256 + n for n, b in enumerate([*range(33), *range(127, 161), 173])}
_SPACE, _LETTER, _DIGIT, _MARK = range(4)


def _kinds() -> np.ndarray:
    kinds = np.full(1 << 16, _MARK, dtype=np.uint8)
    for c in [*range(0x250), 0x2C65, 0x2C66]:  # the last two are small letters of earlier ones
        category = unicodedata.category(chr(c))[0]
        kinds[c] = _LETTER if category == "L" else _DIGIT if category == "N" else _MARK
    kinds[[*range(9, 14), 32]] = _SPACE
    return kinds


class WordEncoder:
    """Ids of texts as the library gives them, without special tokens added.

    Where the vocabulary splits texts by PATTERN, a common text is split here, many
    texts at a time; words that aren't remembered go to the library's model, which
    needs neither normalise nor split them again. All other texts, and texts for other
    vocabularies, are encoded by the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        split, coded = [*((config.get("pre_tokenizer") or {}).get("pretokenizers") or []), {}, {}][:2]
        steps = [n["type"] for n in (config.get("normalizer") or {}).get("normalizers") or []]
        self.split_here = bool(
            config["model"].get("end_of_word_suffix")
            and (split.get("pattern") or {}).get("Regex") == PATTERN
            and coded.get("type") == "ByteLevel"
            and not (coded.get("add_prefix_space") or coded.get("use_regex"))
            and steps == ["NFC", "Replace", "Lowercase"]
        )
        self.model = self.library.model
        self.kinds = _kinds()
        self.memory = RunMemory(self._new_runs, short_names)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        common = []
        for i, t in enumerate(texts):
            if self.split_here and _SPECIAL not in t and not _RARE.search(t):
                common.append(i)
            else:
                out[i] = np.array(self.library.encode(t, add_special_tokens=False).ids, dtype=np.int32)
        for first, group in grouped([texts[i] for i in common]):
            for i, ids in zip(common[first : first + len(group)], self._encode_common(group)):
                out[i] = ids
        return out

    def _encode_common(self, texts: list[str]) -> list[np.ndarray]:
        texts = [t.lower() for t in texts]
        units, bounds = joined_units(texts)
        kinds = self.kinds[units]
        border = np.ones(len(units), dtype=bool)
        border[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)
        heads = np.zeros(len(units) + 3, dtype=bool)
        heads[bounds] = True
        border |= heads[: len(units)]
        # A lone apostrophe before letters begins a contraction; what follows it is a word of its own.
        padded = np.append(units, [0, 0, 0])
        letter = np.append(kinds == _LETTER, [False] * 3) & ~heads
        at = np.flatnonzero((units == ord("'")) & border)
        at = at[letter[at + 1]]
        one, two = padded[at + 1], padded[at + 2]
        length = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
        for pair in ("re", "ve", "ll"):
            length[(one == ord(pair[0])) & (two == ord(pair[1])) & letter[at + 2]] = 2
        at, length = at[length > 0], length[length > 0]
        border[at + 1] = False
        behind = at + 1 + length
        border[behind[behind < len(units)]] = True
        start = np.flatnonzero(border)
        end = np.append(start[1:], len(units))
        words = kinds[start] != _SPACE
        start, end = start[words], end[words]
        ids, counts = self.memory.encode(units, start, end, "".join(texts))
        cuts = per_text(counts, start, bounds)
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def _new_runs(self, runs: list[str]) -> list[list[int]]:
        coded = (r if r.isascii() else r.encode().decode("latin-1").translate(_BYTES) for r in runs)
        return [[token.id for token in self.model.tokenize(c)] for c in coded]


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """One encoder for a worker process, whose memory of words serves all its tasks."""
    return WordEncoder(path)
