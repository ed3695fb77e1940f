"""Token ids of whole texts by a public byte-level vocabulary."""

from __future__ import annotations

import base64
import json
import os
import re

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: Texts of these characters are split alike by both libraries whatever their Unicode version.
_PLAIN = re.compile("[\x00-\x7e¡-ſ]*")


class Encoder:
    """Ids as ``tokenizers`` gives them for the JSON file at ``path``, without special tokens
    added. A byte-level BPE file that has its rank table beside it (same name, ``.tiktoken``) is
    read by ``tiktoken`` as well, which gives the same ids at several times the speed; texts with
    other than Latin characters or with the text of a special token go through ``tokenizers``."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.exact = Tokenizer.from_file(path)
        self.fast = None
        ranks = re.sub("[.]json$", ".tiktoken", path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.special = [t["content"] for t in described["added_tokens"]]
        kind = described["pre_tokenizer"] or {}
        if described["normalizer"] is None and kind.get("type") == "ByteLevel" and ranks != path and os.path.exists(ranks):
            import public_tokenizers

            with open(ranks, "rb") as file:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.fast = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
            )

    def ids(self, text: str) -> np.ndarray:
        if self.fast and _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return self.fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=())
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
