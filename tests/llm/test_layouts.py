"""Main texts of layouts that the test tables lack, marked by hand in ``layouts``."""

import numpy as np
import pytest

from lexiloom.llm import html
from tests.llm.conftest import SF
from tests.llm.layouts import BODY, LAYOUTS, NAV, page


@pytest.fixture(scope="module")
def extracted(spark):
    """The layouts go into the table together with the pages that are learned from."""
    pages = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/pages.parquet").select("page_id", "url", "html")
    rows = spark.createDataFrame([(-1 - i, "u", made) for i, (_, made, _) in enumerate(LAYOUTS)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in html.extract_text(pages.union(rows)).filter("page_id < 0").collect()}


@pytest.mark.parametrize("place", range(len(LAYOUTS)), ids=[name for name, _, _ in LAYOUTS])
def test_layout(extracted, place):
    assert extracted[-1 - place] == LAYOUTS[place][2]


def test_nearest_telling_element_decides():
    def told(path):
        return html.told_by(tuple(tuple(e.split()) for e in path.split("/")), set())

    assert told("body has-sidebar/div post-header/article/p") == 1
    assert told("body/article related-posts-enabled/p") == 1
    assert told("body/article comment/p") == told("body/article/div comment-body/p") == told("body/main/nav/ul/li") == 0
    assert told("body/article/header/h1") == 1 and told("body/article/header/p") == 0
    assert told("body/div row/p") is told("html/body") is None
    assert told("body/div post-body/p") == 1 and told("body/div post-footer/p") == 0


def test_wrappers_tell_nothing():
    blocks = html.read_blocks(page(f'<form id="aspnetForm">{NAV}<div><p>{"A long text. " * 30}</p></div></form>'))
    labels = dict(zip((b.text[:6] for b in blocks), html.known_labels(blocks)))
    assert labels["A long"] is None and labels["World"] == 0
    comments = html.read_blocks(page(f'<article><p>Short.</p></article><div id="comments"><p>{"Me too! " * 50}</p></div>'))
    assert html.known_labels(comments)[-2:] == [1, 0]


def test_parts_of_a_page_have_the_vectors_of_the_whole():
    blocks = html.read_blocks(page(NAV + BODY * 3))
    whole = html.vectors(blocks)
    parts = [html.vectors(blocks, range(i, min(i + 4, len(blocks)))) for i in range(0, len(blocks), 4)]
    assert np.array_equal(whole, np.concatenate(parts))


def test_lines_are_cut_by_known_elements_only():
    made = "<p>a <label>b</label> <x-y>c</x-y> <math><mi>d</mi></math></p><svg>e</svg><template>f</template><select><option>g<option>h</select>i"
    assert [b.text for b in html.read_blocks(made)] == ["a b c d", "g", "h", "i"]
