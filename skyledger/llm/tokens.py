"""Token ids of a public byte-level vocabulary, for operators that only need its counts."""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import tiktoken

#: Vocabulary by file name; its ranks are those of ``byte_bpe_50k.json``.
RANKS = "byte_bpe_50k.tiktoken"
END_OF_TEXT = "<|endoftext|>"
SPECIAL_ID = 50256
#: The library's matcher keeps a state for each of the blanks in a row and ends at a million.
LONG_RUN = 500_000
_BLANK = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_LONG_BLANKS = re.compile(f"{_BLANK}{{{LONG_RUN},}}")


@functools.cache
def encoder(ranks: str = RANKS) -> tiktoken.Encoding:
    with open(public_tokenizers.path(ranks), "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        ranks,
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=merges,
        special_tokens={END_OF_TEXT: SPECIAL_ID},
    )


def encode(text: str, ranks: str = RANKS) -> np.ndarray:
    """Ids of a whole text; the end-of-text mark is one id, as the tokenizers library has it."""
    own = encoder(ranks)
    if len(text) < LONG_RUN or not _LONG_BLANKS.search(text):
        return own.encode_to_numpy(text, allowed_special="all")
    return np.concatenate([np.asarray(ids, np.uint32) for ids in _in_parts(own, text)])


def _in_parts(own: tiktoken.Encoding, text: str) -> Iterator[list[int]]:
    """Long runs of blanks are words of their own: all of them at the end of a text, all but
    the last one before other text, which that one may belong to."""
    for part in re.split(f"({re.escape(END_OF_TEXT)})", text):
        if part == END_OF_TEXT:
            yield [SPECIAL_ID]
            continue
        at = 0
        for run in _LONG_BLANKS.finditer(part):
            end = run.end() - (run.end() < len(part))
            yield own.encode(part[at : run.start()], disallowed_special=())
            yield own._core_bpe.encode_single_piece(part[run.start() : end].encode())
            at = end
        yield own.encode(part[at:], disallowed_special=())
