"""Token counts of a byte-level BPE vocabulary with a whole-token shortcut.

Most pre-tokens of real text are vocabulary entries.  Before any text is read,
:func:`prove_whole` runs the merges over every vocabulary string by itself and
keeps those that end as exactly one token.  A pre-token in that set counts as one
without merging; only the rest is merged, by the library's own merge loop.
"""

from __future__ import annotations

import json

import pandas as pd
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from sheafline.llm.common import bounded_batches, without

# The published pre-token pattern of byte-level BPE.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Ranges whose character classes are the same in ``regex`` and in the
# tokenizer library (the test walks through all of them).  A text with any other
# character is counted by the library, since the two follow different Unicode versions.
AGREED = (
    r"\x00-՗א-תؠ-ۿऄ-हก-ฺ"
    r"Ḁ-ỿ -⁤₠-₿℀-⅏←-⏺─-➿"
    r"　-〿ぁ-ゖァ-ヿ一-鿯가-힣！-ﾾ\U0001F300-\U0001F64F"
)
# Results of merged pre-tokens kept per worker, and the longest one worth keeping.
CACHE_ENTRIES = 300_000
CACHE_LENGTH = 200
TOKEN_LIMIT = 512

_COUNTERS = {}


def byte_alphabet():
    """Byte -> character, as byte-level BPE writes bytes: printable Latin-1
    characters stand for themselves, the rest takes code points from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


def prove_whole(definition):
    """The vocabulary strings, as text, that the merges leave as one token."""
    tokenizer = Tokenizer.from_str(definition)
    byte_of = {c: b for b, c in byte_alphabet().items()}
    proven = []
    for entry in tokenizer.get_vocab(with_added_tokens=False):
        if len(tokenizer.model.tokenize(entry)) == 1 and all(c in byte_of for c in entry):
            try:
                proven.append(bytes(byte_of[c] for c in entry).decode("utf-8"))
            except UnicodeDecodeError:
                continue  # part of a character is never a pre-token
    return proven


def check_definition(definition):
    """Raise unless the counting rules below hold for this tokenizer."""
    parts = json.loads(definition)
    pre = parts.get("pre_tokenizer") or {}
    ok = (
        parts["model"]["type"] == "BPE"
        and not parts["model"].get("dropout")
        and not parts["model"].get("unk_token")
        and not parts.get("normalizer")
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space")
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in parts["added_tokens"])
    )
    if not ok:
        raise ValueError("only plain byte-level BPE tokenizers are supported")


class PieceCounts(dict):
    """Pre-token -> number of tokens; starts from the proven entries."""

    def __init__(self, model, whole):
        super().__init__(dict.fromkeys(whole, 1))
        self.model, self.whole, self.alphabet = model, whole, byte_alphabet()

    def __missing__(self, piece):
        alphabet = self.alphabet
        n = len(self.model.tokenize("".join([alphabet[b] for b in piece.encode("utf-8")])))
        if len(piece) <= CACHE_LENGTH:
            if len(self) >= CACHE_ENTRIES + len(self.whole):
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
            self[piece] = n
        return n


class TokenCounter:
    def __init__(self, definition, whole):
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [t["content"] for t in json.loads(definition)["added_tokens"]]
        special.sort(key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.find = regex.compile(PRETOKEN).findall
        self.unknown = regex.compile(f"[^{AGREED}]").search
        self.counts = PieceCounts(self.tokenizer.model, whole)

    def __call__(self, text):
        if not text:
            return 0
        if not text.isascii() and self.unknown(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        parts = self.special.split(text) if self.special else [text]
        return len(parts) - 1 + sum(sum(map(self.counts.__getitem__, self.find(p))) for p in parts)


def _counter(shared):
    """One counter per worker process and broadcast."""
    if shared.value[0] not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[shared.value[0]] = TokenCounter(*shared.value)
    return _COUNTERS[shared.value[0]]


def read_definition(path):
    with open(path, encoding="utf-8") as f:
        return f.read()


def count_tokens(docs, definition, text="text", limit=TOKEN_LIMIT):
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    ``definition`` is the JSON text of a byte-level BPE tokenizer; it and the proven
    strings are broadcast, which the vocabulary bounds.  Whole texts count; null and
    empty texts have 0 bytes and 0 tokens.  Strings of special tokens inside a text
    count as one token, nothing is added around it.  Bytes that are not UTF-8 count as the
    replacement characters they become.  Repeated rows give repeated
    results, an empty table an empty one; columns with the new names are replaced.
    A narrow job: no shuffle, only the text goes to Python.
    """
    check_definition(definition)
    shared = docs.sparkSession.sparkContext.broadcast((definition, prove_whole(definition)))

    @F.pandas_udf(T.LongType())
    def tokens(text: pd.Series) -> pd.Series:
        count = _counter(shared)
        return pd.Series([count(t) for t in text], dtype="int64")

    valid = F.make_valid_utf8(F.col(text))
    kept = without(bounded_batches(docs), "n_bytes", "n_tokens", "over_limit")
    counted = kept.withColumns(
        {
            "n_bytes": F.coalesce(F.octet_length(valid), F.lit(0)).cast("long"),
            "n_tokens": tokens(F.coalesce(valid, F.lit(""))),
        }
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
