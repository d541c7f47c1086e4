"""Windows so long that one anchor can serve more of them than a packed count holds."""

import hashlib
import random

from cohortviews.llm import substring_dedup


def test_op2_with_a_long_length(spark):
    rng = random.Random(4)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared, length = text(6000), 1200
    rows = [(1, text(50) + shared), (2, shared[700:5000] + text(300)), (3, text(2000)), (4, text(90) + shared[100:2000] + text(40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in substring_dedup.deduplicated(docs, length).collect()}
    seen = set()
    for doc_id, t in rows:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if t[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(t[p : p + length])
        kept = "".join(c for c, g in zip(t, gone) if not g)
        assert (got[doc_id].n_removed, got[doc_id].kept_sha256) == (sum(gone), hashlib.sha256(kept.encode()).hexdigest())
