"""Very long runs of digits, white space and keys: defined results, time in proportion."""

import random
import time

import pytest

from fieldglean.llm import bpe, pii, secrets


@pytest.fixture(scope="module")
def enc():
    import public_tokenizers

    return bpe.encoding(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)


@pytest.mark.parametrize("text", [" " * 1_000_000, "a" + "\n" * 300_000 + "b", "x" * 500_000, "1" * 500_000, "!" * 500_000, ("é" + " " * 5000) * 100])
def test_runs_are_encoded(enc, text):
    assert enc.decode_bytes(bpe.encode_text(enc, text).tolist()).decode() == text


def test_runs_of_white_space_as_the_pattern_has_them(enc, monkeypatch):
    monkeypatch.setattr(bpe, "_LONG_SPACE", bpe.re.compile(f"[{bpe._SPACES}]{{2,}}"))
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice([" ", "  ", "\n", "\t", " ", "　", "a", "1", "!", "'s", "é", "\x1c", "\r\n"]) for _ in range(rng.randint(0, 40)))
        assert bpe.encode_text(enc, text).tolist() == enc.encode_ordinary(text)


def test_long_numbers_are_no_addresses():
    assert [s for s in pii.base_spans("0" * 5000 + ".0.0.1 and " + "9" * 5000 + ".1.1.1 and 1.2.3.400 x") if s[0] == "ip"] == [("ip", 0, 5006)]


def test_many_keys_in_one_text(spark):
    n = 60_000
    parts = [f"{i * 7919:016x}" if i % 3 else "Zx9Qk+/aB77yTq0Lm" for i in range(n)]
    start = time.perf_counter()
    row, = secrets.scan(spark.createDataFrame([(1, " ".join(parts))], "doc_id long, text string"), [1.0] * (128 * 128)).collect()
    assert time.perf_counter() - start < 60
    at, want = 0, []
    for part in parts:
        want.append((at, at + len(part)))
        at += len(part) + 1
    assert [(s["start"], s["end"]) for s in row["base_spans"]] == [w for i, w in enumerate(want) if i % 3]
    assert [(s["start"], s["end"]) for s in row["random_spans"]] == want[::3]
    assert row["n_hex"] == len(row["base_spans"])


def test_spans_that_touch(spark):
    """Random runs beside, inside and around base spans: kept only where they touch none."""
    rng = random.Random(4)
    texts = ["".join(rng.choice(["token=", "0123456789abcdef", "AKIA", "ABCDEFGHIJKLMNOP", "Zx9QkaB77yTq0LmRe", " ", ":", "\"", "/", ". "]) for _ in range(30)) for _ in range(200)]
    got = secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), [1.0] * (128 * 128)).collect()
    for row in got:
        base = [(s["start"], s["end"]) for s in row["base_spans"]]
        text = texts[row["doc_id"]]
        runs = [m.span() for m in bpe.re.finditer(secrets.CANDIDATE, text) if len(m[0]) - 1 >= secrets.LEAST_TOTAL]
        assert [(s["start"], s["end"]) for s in row["random_spans"]] == [r for r in runs if not any(a < r[1] and r[0] < b for a, b in base)]
