"""Plain Python versions of what the operators compute."""

import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
_CACHE = {}


def reference_ids(name, text):
    if name not in _CACHE:
        _CACHE[name] = Tokenizer.from_file(public_tokenizers.path(name))
    return _CACHE[name].encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def doc_rows(spark):
    return [r.asDict() for r in documents(spark).collect()]


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(words) >= 5:
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    return {tuple(words)} if words else set()


def link_groups(rows):
    """(doc_id, text) -> doc_id: smallest doc_id of its group, by all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((top(i), top(j)))
                parent[high] = low
    return {i: top(i) for i in parent}
