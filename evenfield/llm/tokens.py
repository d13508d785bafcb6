"""Ids of the public byte-level BPE vocabulary, as the tokenizers library gives them.

Ordinary texts go through tiktoken with the same vocabulary as ranks, which gives the same ids several times as fast;
texts with characters on which the two pattern engines might differ (control characters, and all beyond Latin
letters and common punctuation) go through tokenizers itself, and so do texts that hold the string of a special token,
which tokenizers takes for that token.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

#: Texts of these characters alone: printable ASCII, tab, line feed, Latin-1 letters and Latin Extended-A.
PLAIN = re.compile("[\t\n\x20-\x7eÀ-ſ]*")
#: White space runs beyond this length are left to tokenizers.
LONG_RUN = re.compile(r"\s{5000}")


@lru_cache(maxsize=1)
def encoder(json_path: str, ranks_path: str | None):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(json_path)
    special = re.compile("|".join(re.escape(t.content) for t in exact.get_added_tokens_decoder().values()) or "(?!)")

    def slow(text: str) -> list[int]:
        return exact.encode(text, add_special_tokens=False).ids

    if ranks_path is None:
        return slow
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    quick = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if PLAIN.fullmatch(text) and not LONG_RUN.search(text) and not special.search(text):
            return quick.encode_ordinary(text)
        return slow(text)

    return encode


def vocabulary_paths(name: str = "byte_bpe_50k") -> tuple[str, str | None]:
    """Paths of a public vocabulary: the tokenizers file and its ranks."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken")
