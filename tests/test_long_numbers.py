"""Numbers of any length in texts, against Python's own integers."""

import random
import re

from fieldglean import queries as registry


def test_numbers_of_any_length(spark, tmp_path):
    registry.load_all()
    rng = random.Random(8)
    texts = ["0", "007 a 08", "9" * 38 + " 1", "0" * 50, "1 " + "0" * 40 + "2", None, "none", "5" * 37 + " 6", "9" * 37 + " " + "9" * 37, "9" * 34 + " " + "9" * 51, "1" + "0" * 400]
    texts += [" ".join("".join(rng.choice("0129") for _ in range(rng.randrange(1, 90))) for _ in range(rng.randrange(1, 4))) for _ in range(150)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {}
    for i, t in enumerate(texts):
        n = [int(x) for x in re.findall("[0-9]+", t or "")]
        if n:
            total = min(n) + max(n)
            want[i] = (str(min(n)), str(max(n)), f"{total // 2}.{total % 2 * 5} sq. ft.")
    got = registry.QUERIES["numbers_min_max_mid"](spark, str(tmp_path)).collect()
    assert {r["doc_id"]: (r["lo"], r["hi"], r["mid"]) for r in got} == want and len(got) == len(want)
