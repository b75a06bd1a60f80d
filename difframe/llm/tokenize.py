"""Corpus encoding with a public byte-level BPE vocabulary.

The vocabulary is a local rank file (base64 token, rank per line).  Every Python worker builds the encoder once;
rows stream through as Arrow batches, so no shuffle happens and the plan is one scan, one map.

Long texts are cut at *safe boundaries* before they are encoded, so that the ids of the parts, joined, are the ids of
the whole.  Two kinds of place are safe:

* between characters that the split pattern never takes into one piece: behind a letter that no letter follows, behind a
  number that no number follows, between a mark (but no apostrophe) and a letter, number, blank or line feed;
* inside a run of letters, where writing knows no blanks: between two characters whose touching bytes stand side by side
  in no token of the vocabulary, so that no merge can cross.
"""

from __future__ import annotations

import base64
import functools
import unicodedata

import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Folder of the public vocabulary files.
VOCABULARY_DIR = "/opt/tokenizers"
#: Texts longer than this many characters are cut at safe boundaries.
PART_CHARS = 50_000
#: An output batch is sent once it holds this many ids.
BATCH_IDS = 1_000_000

# The split patterns that belong to the vocabularies.
BYTE_BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SAFE = regex.compile(r"(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})|(?<=[^\s\p{L}\p{N}'])(?=[\p{L}\p{N} \n])")
#: Characters searched at once for a safe boundary.
_REACH = 2_000


@functools.lru_cache(maxsize=4)
def encoder(ranks_file: str, pattern: str = BYTE_BPE_PATTERN):
    """The encoder of a rank file, without special tokens; built once per process."""
    import tiktoken

    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(ranks_file, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def _touching(ranks_file: str) -> frozenset[int]:
    """The pairs of bytes (first * 256 + second) that stand side by side in some token."""
    with open(ranks_file, "rb") as f:
        tokens = [base64.b64decode(line.split()[0]) for line in f if line.strip()]
    return frozenset(a << 8 | b for t in tokens for a, b in zip(t, t[1:], strict=False))


def _settled(text: str, at: int) -> bool:
    """Whether the characters around a place have been in Unicode for long: all libraries class them alike."""
    old = unicodedata.ucd_3_2_0.category
    return all(old(c) != "Cn" and old(c)[0] == unicodedata.category(c)[0] for c in text[at - 1 : at + 1])


def _safe_place(text: str, start: int, touching: frozenset[int] | None) -> int | None:
    """The first safe place behind ``start``; the whole rest is searched, a stretch at a time."""
    while start < len(text):
        end = min(len(text) - 1, start + _REACH)
        for m in _SAFE.finditer(text, start, end):
            if start < m.start() < end and _settled(text, m.start()):
                return m.start()
        for i in range(start + 1, end) if touching is not None else ():
            a, b = text[i - 1], text[i]
            if a.isalpha() and b.isalpha() and a.encode()[-1] << 8 | b.encode()[0] not in touching and unicodedata.category(a)[0] == unicodedata.category(b)[0] == "L" and _settled(text, i):
                return i
        start += max(_REACH - 2, 1)
    return None


def parts(text: str, size: int = PART_CHARS, ranks_file: str | None = None):
    """Yields ``text`` in parts of about ``size`` characters, cut at safe boundaries only; with ``ranks_file`` also inside
    runs of letters.  A stretch without a safe boundary stays whole however long it is."""
    start = 0
    touching = _touching(ranks_file) if ranks_file else None
    while len(text) - start > size:
        cut = _safe_place(text, start + size - 1, touching)
        if cut is None:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def encode_text(text: str | None, enc, size: int = PART_CHARS) -> list[int]:
    """Ids of one text; an empty or null text gives an empty list."""
    if not text:
        return []
    if len(text) <= size:
        return enc.encode_ordinary(text)
    # The encoder is named after its rank file.
    return [i for part in parts(text, size, enc.name) for i in enc.encode_ordinary(part)]


def decode_bytes(ids, enc) -> bytes:
    """The raw bytes of a list of ids: exact also where an id ends inside a character."""
    return enc.decode_bytes([int(i) for i in ids])


def encode_corpus(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks_file: str = f"{VOCABULARY_DIR}/byte_bpe_50k.tiktoken",
    pattern: str = BYTE_BPE_PATTERN,
    ids_col: str = "ids",
) -> DataFrame:
    """``id_col`` and the ids of ``text_col`` for every row, without special tokens.

    Defined results: null and empty texts give an empty list; texts of blanks are encoded as they stand; strings of
    special tokens are ordinary text; repeated rows stay repeated; null ids stay null; an empty table gives an empty
    table.  Other columns are not read, so clashing names do not matter.
    """
    schema = T.StructType([docs.schema[id_col], T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    def encode(batches):
        from array import array

        import numpy as np
        import pyarrow as pa

        enc = encoder(ranks_file, pattern)
        kind = pa.list_(pa.field("element", pa.int32()))
        for batch in batches:
            ids, ends, first = array("i"), [0], 0
            for row, text in enumerate(batch.column(1)):
                ids.extend(encode_text(text.as_py(), enc))
                ends.append(len(ids))
                if len(ids) >= BATCH_IDS or row + 1 == len(batch):
                    lists = pa.ListArray.from_arrays(pa.array(np.array(ends, "int32")), pa.array(np.frombuffer(ids, "int32")), type=kind)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, row + 1 - first), lists], names=[id_col, ids_col])
                    ids, ends, first = array("i"), [0], row + 1

    return docs.select(id_col, text_col).mapInArrow(encode, schema)


def decode_corpus(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", ranks_file: str = f"{VOCABULARY_DIR}/byte_bpe_50k.tiktoken", pattern: str = BYTE_BPE_PATTERN, bytes_col: str = "bytes") -> DataFrame:
    """``id_col`` and the raw bytes of ``ids_col``: exact also where ids end inside a character.

    Defined results: an empty or null list gives no bytes (not null); an id outside the vocabulary is an error of the
    row's task; repeated rows stay repeated; an empty table gives an empty table.
    """
    schema = T.StructType([encoded.schema[id_col], T.StructField(bytes_col, T.BinaryType())])

    def decode(batches):
        import pyarrow as pa

        enc = encoder(ranks_file, pattern)
        for batch in batches:
            lists = batch.column(1)
            flat, ends, given = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_pylist(), lists.is_valid().to_pylist()
            out = [enc.decode_bytes(flat[ends[i] : ends[i + 1]].tolist()) if ok else b"" for i, ok in enumerate(given)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=[id_col, bytes_col])

    return encoded.select(id_col, ids_col).mapInArrow(decode, schema)
