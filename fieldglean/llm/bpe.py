"""Byte-level BPE with a local rank file: encoding in bounded pieces, decoding to raw bytes."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglean.llm.common import pick, prepare

#: Texts above this many characters are split before they are handed to the tokenizer.
PIECE_CHARS = 100_000
#: No match of the pattern crosses the place between a non-space and a single space or line break that another
#: non-space follows: white space can only begin a match there, and nothing looks back.
_SAFE = re.compile(r"\S(?=[ \n]\S)")
#: Longer runs of white space (of Unicode) are matched here: the pattern's engine would need a stack as deep as the run.
LONG_SPACE = 1000
_SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LONG_SPACE = re.compile(f"[{_SPACES}]{{{LONG_SPACE},}}")
TYPES = {"ids": "array<int>", "n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
_encodings: dict[tuple[str, str], object] = {}


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encoding(ranks: bytes, pattern: str):
    """The tokenizer of a rank file's content, made once per worker process."""
    import tiktoken

    key = (hashlib.sha256(ranks).hexdigest(), pattern)
    if key not in _encodings:
        pairs = (line.split() for line in ranks.splitlines() if line.strip())
        _encodings[key] = tiktoken.Encoding("local", pat_str=pattern, special_tokens={},
                                            mergeable_ranks={base64.b64decode(t): int(r) for t, r in pairs})
    return _encodings[key]


def pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces of about `limit` characters, cut at safe places only; a piece without one stays longer."""
    at = 0
    while len(text) - at > limit:
        found = _SAFE.search(text, at + limit - 1)
        if not found:
            break
        yield text[at:found.end()]
        at = found.end()
    yield text[at:] if at else text


def encode_text(enc, text: str, limit: int = PIECE_CHARS) -> np.ndarray:
    """Ids of a text. A match that is a long run of white space, all of it at the end of a text and all but its last character
    before something else, goes to the merges as one piece; the pattern sees what lies between such runs."""
    parts, at = [], 0
    for run in _LONG_SPACE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        parts += [np.array(enc.encode_ordinary(p), np.uint32) for p in pieces(text[at:run.start()], limit)]
        parts.append(np.array(enc._encode_single_piece(text[run.start():end]), np.uint32))
        at = end
    parts += [np.array(enc.encode_ordinary(p), np.uint32) for p in pieces(text[at:] if at else text, limit)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def tokenize(docs: DataFrame, ranks: bytes, pattern: str, outputs: Sequence[str] = ("ids", "n_tokens"),
             key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key and the asked outputs (ids, n_tokens, ids_sha256, decoded_sha256).

    Null and empty texts have no ids. Strings of special tokens are ordinary text. Rows are handled one by one, so
    repeated rows and null keys stay; an empty table gives an empty result; other columns are not looked at. The ranks
    (the content of a rank file, a few MB whatever the data) go to the workers as a broadcast variable.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = pick(docs, key, text)
    shared, outputs = spark.sparkContext.broadcast(ranks), tuple(outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(shared.value, pattern)
        for batch in batches:
            made = {c: [] for c in outputs}
            for value in batch.column(1):
                ids = encode_text(enc, (value.as_py() or b"").decode("utf-8", "replace"))
                if "ids" in made:
                    made["ids"].append(ids.astype(np.int32))
                if "n_tokens" in made:
                    made["n_tokens"].append(len(ids))
                if "ids_sha256" in made:
                    made["ids_sha256"].append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                if "decoded_sha256" in made:
                    made["decoded_sha256"].append(hashlib.sha256(enc.decode_bytes(ids.tolist())).hexdigest())
            kinds = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64()}
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(made[c], kinds.get(c, pa.string())) for c in outputs],
                                             [key, *outputs])

    schema = ", ".join([f"`{key}` {rows.schema[key].dataType.simpleString()}", *(f"{c} {TYPES[c]}" for c in outputs)])
    return rows.select(key, F.col(text).cast("binary")).mapInArrow(run, schema)


def detokenize(tokens: DataFrame, ranks: bytes, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: the key and `bytes` (binary), the raw bytes of the ids; they need not be UTF-8. Null ids give null."""
    spark = tokens.sparkSession
    prepare(spark)
    rows = pick(tokens, key, ids)
    shared = spark.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(shared.value, pattern)
        for batch in batches:
            out = [None if v is None else enc.decode_bytes(v) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], [key, "bytes"])

    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, bytes binary")
