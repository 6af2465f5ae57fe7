"""The registered totals show the revised rollup and the one that covers all rows."""

import re
from collections import defaultdict

from tests.llm.conftest import SMALL
from wattledger.llm import catalog


def test_op2_returns_both_states(spark, tables):
    want = defaultdict(lambda: [0, 0])
    seen = set()
    for r in tables["documents"].orderBy("doc_id").collect():
        text = r["text"] or ""
        words = len(re.findall(r"[^\x20\x09-\x0D]+", text))
        for name, n in (("words-1", words), ("digits-1", len(re.findall(r"[0-9]|[^0-9\x20\x09-\x0D]+", text)))):
            counts = {"all": n} | ({"changed": 0 if text in seen else n} if words >= 5 else {})
            for state, tokens in counts.items():
                want[state, r["source"], r["lang"], name][0] += 1
                want[state, r["source"], r["lang"], name][1] += tokens
        seen.add(text)
    rows = catalog.QUERIES["op2_token_counts"](spark, SMALL).collect()
    assert len(rows) == len(want)
    assert {tuple(r)[:4]: [r["n_docs"], r["n_tokens"]] for r in rows} == want
    both = {state: sum(n for (s, *_), (_, n) in want.items() if s == state) for state in ("all", "changed")}
    assert 0 < both["changed"] < both["all"]
