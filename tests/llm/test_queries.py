"""The thin queries keep their contracts' columns and digests on the small tables."""

import hashlib
import os

import pytest

from chunkloom.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm.test_spans import plain_pii, plain_secrets

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name, plain, kinds", [("op2_secret_scan", plain_secrets, ("assign", "access", "hex")), ("op3_pii", plain_pii, ("email", "ip", "card", "phone"))])
def test_spans(spark, name, plain, kinds):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = QUERIES[name](spark, SF).collect()
    assert len(out) == len(texts)
    for r in out:
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r.spans.split(",")) | {""}
        for k in kinds:
            assert r[f"n_{k}"] == sum(s.startswith(k + ":") for s in want)
