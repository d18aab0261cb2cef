"""Generators get an item at a time, and their requests leave in slices."""

import pyarrow as pa

from pagemill.operators import generator as G


def test_generated_requests_leave_in_slices():
    n = 3 * G.SLICE_REQUESTS + 1
    batch = pa.RecordBatch.from_pydict({"source_url": [f"http://a.test/{i}" for i in range(n)], "body": ["x"] * (n - 1) + [None],
                                        "data_json": ['{"t": "1"}'] * n, "seq": [[0, i] for i in range(n)]})

    def one(body, url, data):
        if url.endswith("/5"):
            raise ValueError("five")
        return [{"url": url + "?p=2", "headers": {1: 2, "1": 3}, "meta": {"context": data}}]

    out = list(G.generated([batch], one, 4, {}))
    assert [b.num_rows for b in out] == [G.SLICE_REQUESTS] * 3 + [1]
    rows = [r for b in out for r in b.to_pylist()]
    assert [r["seq"] for r in rows] == [[0, i] if i == 5 else [1, i, 0] for i in range(n)]
    assert rows[5]["error"] == "generator failed: five" and rows[5]["payload"] == "http://a.test/5"
    assert rows[0]["headers"] == [("1", "3")] and rows[0]["meta"]["context"] == [("t", "1")]
