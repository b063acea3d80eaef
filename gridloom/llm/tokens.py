"""Token counts with a whole-token shortcut.

The vocabulary's strings that its own library encodes alone as one token are found
beforehand (``prove_single``). A text is cut at ASCII white space, which no token
crosses; each piece is normalised and split into pre-tokens by the library's own steps,
proven pre-tokens count one, and only the rest go through the merges. Pieces that hold
the start of a special string go through the library's full encoder, which treats those
strings as it does by default. Counts of pieces are kept in a table of bounded size,
which is emptied when full.

The shortcut holds for word-level BPE vocabularies, whose tokens end words with a suffix and
never cross white space. ``PieceCounts`` checks that, by the vocabulary's settings and on
``PROBES``, and raises ValueError for any other kind (byte-level with leading blanks,
unigram or sentencepiece models).

Nulls: a null text is empty. Very long texts are counted whole; pieces are merged one by
one, so their cost is that of the longest piece without white space. Every row gives one row, repeated rows included; an empty table
an empty result. Only the two named columns are read; extra columns of any name are not.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEPT_PIECES = 400_000
#: Texts whose count must be the sum of their pieces' counts.
PROBES = ("a b", "the  quick\tbrown\nfox", "it's 12 don't-stop ...", "Ünïcode ß 字 ΣΑΣ", " lead and trail ")


def vocabulary_path(name_or_path: str) -> str:
    """A path as it is; a bare file name is one of the installed public vocabularies."""
    if "/" in name_or_path:
        return name_or_path
    import public_tokenizers

    return public_tokenizers.path(name_or_path)


def word_suffix(path: str) -> str:
    """What ends a word in the vocabulary's tokens; ValueError if it is of another kind."""
    if not path.endswith(".json"):
        raise ValueError(f"{path}: a word-level BPE vocabulary in JSON is needed")
    with open(path, encoding="utf-8") as f:
        parts = json.load(f)
    model = parts.get("model") or {}
    suffix = model.get("end_of_word_suffix")
    if model.get("type") != "BPE" or not suffix or model.get("dropout") or not parts.get("normalizer") or not parts.get("pre_tokenizer"):
        raise ValueError(f"{path}: no word-level BPE vocabulary with a normaliser, a pre-tokeniser and a suffix that ends words")
    return suffix


def prove_single(tokenizer, suffix: str) -> frozenset:
    """Pre-tokens, as the pre-tokenizer writes them, that the merges turn into one token."""
    candidates = [v[: -len(suffix)] for v in tokenizer.get_vocab(with_added_tokens=False) if v.endswith(suffix) and len(v) > len(suffix)]
    return frozenset(c for c in candidates if len(tokenizer.model.tokenize(c)) == 1)


class PieceCounts(dict):
    """Tokens of each white-space-free piece (UTF-8 bytes), found on first use."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        path = vocabulary_path(vocabulary)
        suffix = word_suffix(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.single = prove_single(self.tokenizer, suffix)
        self.special = tuple(t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values())
        for text in PROBES:
            if sum(self[p] for p in text.encode().split()) != len(self.tokenizer.encode(text, add_special_tokens=False).ids):
                raise ValueError(f"{path}: tokens cross white space")

    def __missing__(self, piece: bytes) -> int:
        text = piece.decode("utf-8", "replace")
        tok = self.tokenizer
        if any(s in piece for s in self.special):
            n = len(tok.encode(text, add_special_tokens=False).ids)
        else:
            cut = tok.pre_tokenizer.pre_tokenize_str(tok.normalizer.normalize_str(text))
            n = sum(1 if p in self.single else len(tok.model.tokenize(p)) for p, _ in cut)
        if len(self) >= KEPT_PIECES:
            self.clear()
        self[piece] = n
        return n


@lru_cache(maxsize=2)
def piece_counts(vocabulary: str) -> PieceCounts:
    return PieceCounts(vocabulary)


def count_tokens(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_bytes and n_tokens for each row."""
    word_suffix(vocabulary_path(vocabulary))  # fails here rather than in the tasks
    narrow = docs.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("_text"))
    schema = f"`{id_col}` {narrow.schema[0].dataType.simpleString()}, n_bytes long, n_tokens long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = piece_counts(vocabulary).__getitem__
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            n = pa.array([sum(map(of, t.split())) if t else 0 for t in (x.as_py() for x in texts)], pa.int64())
            size = pc.fill_null(pc.binary_length(texts).cast(pa.int64()), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), size, n], names=[id_col, "n_bytes", "n_tokens"])

    return narrow.mapInArrow(count, schema)
