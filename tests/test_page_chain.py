"""Landed pages make one chain of links, read in its order."""

import json
import os
import random
import tempfile

import pytest

from wattline.sources import pages


def land(links, results=None, flat=True):
    """Files of pages {file number: [(next, readings)]}; returns their folder."""
    root = tempfile.mkdtemp(prefix="wattline-chain-")
    for number, lines in links.items():
        with open(f"{root}/page-{number}.json", "w") as f:
            for to, kwh in lines:
                rows = [{"interval_start": "2024-01-01T00:00:00Z", "consumption": str(k)} for k in kwh]
                f.write(json.dumps({"next": to and f"https://x.example/?page={to}&page_size=2", "results": rows}) + "\n")
    return root


def order(spark, root):
    return [r.kwh for r in pages.usage_rows(spark, root).orderBy("page", "pos").collect()]


def test_the_chain_gives_the_order(spark):
    numbers = [1, *random.Random(5).sample(range(2, 90), 12)]               # links, not numbers, tell the order
    files = {n: [(to, [i, i + 0.5])] for i, (n, to) in enumerate(zip(numbers, [*numbers[1:], None]))}
    assert order(spark, land(files)) == [x for i in range(13) for x in (i, i + 0.5)]


def test_several_pages_in_a_file_keep_their_order(spark):
    assert order(spark, land({1: [(2, [1.0]), (3, [2.0]), (4, [3.0])], 4: [(5, [4.0]), (None, [5.0])]})) == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert order(spark, land({1: [(None, [1.0])], 2: [(None, [2.0]), (None, [3.0])]})) == [1.0, 2.0, 3.0]      # none links on


@pytest.mark.parametrize("files, fault", [
    ({1: [(2, [1.0])]}, "missing: page 2"),
    ({1: [(2, [1.0])], 3: [(None, [2.0])]}, "missing: page 2"),
    ({1: [(2, [1.0])], 2: [(3, [2.0]), (None, [3.0])], 3: [(None, [4.0])]}, "there twice: page 3"),
    ({1: [(3, [1.0])], 2: [(3, [2.0])], 3: [(None, [4.0])]}, "several pages link to page 3"),
    ({1: [(2, [1.0])], 2: [(None, [2.0])], 7: [(None, [4.0])]}, "no page links to page 7"),
    ({1: [(None, [1.0]), (4, [2.0])], 4: [(None, [3.0])]}, "follows the last one in the file of page 1"),
    ({1: [(2, [1.0])], 2: [(None, [2.0])], 5: [(6, [1.0])], 6: [(5, [1.0])]}, "circle at page 5"),
    ({1: [("x", [1.0])]}, "without a page number"),
])
def test_broken_chains_fail_by_name(spark, files, fault):
    with pytest.raises(Exception, match=fault):
        pages.usage_batch(spark, land(files)).collect()


def test_each_code_has_its_chain(spark):
    root = tempfile.mkdtemp(prefix="wattline-chain-")

    def put(code, page, to, rate):
        os.makedirs(f"{root}/tariff_code={code}/page={page}")
        with open(f"{root}/tariff_code={code}/page={page}/a.json", "w") as f:
            f.write(json.dumps({"next": to and f"?page={to}", "results": [{"valid_from": "2024-01-01T00:00:00Z", "value_inc_vat": rate}]}) + "\n")
    for code in ("E-1R-A-1", "E-1R-B-1"):
        put(code, 9, 2, "1.0")
        put(code, 2, None, "2.0")
    assert [r.unit_rate for r in pages.rate_rows(spark, root).collect()] == [1.0, 1.0]
    put("E-1R-C-1", 1, 2, "1.0")
    with pytest.raises(pages.PageChainError, match="missing: page 2 .tariff_code=E-1R-C-1"):
        pages.rate_rows(spark, root)
