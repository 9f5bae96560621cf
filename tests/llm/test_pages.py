"""Layout of pages: spans of cells, controls, style sheets, nested lists."""

import tracemalloc

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from curbcount.llm.html_text import visible_text


def test_wide_cells_cost_no_memory():
    page = "<table><tr>" + "<td rowspan=1000 colspan=1000>x" * 20 + "</tr>" + "<tr><td>y</tr>" * 3 + "</table>"
    tracemalloc.start()
    text = visible_text(page)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5 << 20 and text.split() == ["x"] * 20 + ["y"] * 3
    assert visible_text("<table>" + "<tr><td colspan=1000>a" * 2000 + "</table>").split() == ["a"] * 2000


def grid_by_hand(rows):
    """Column of every cell, from a grid of single cells."""
    taken, out = set(), []
    for r, cells in enumerate(rows):
        c = 0
        for across, down in cells:
            while (r, c) in taken:
                c += 1
            out.append((r, c))
            taken |= {(r + k, c + j) for k in range(down) for j in range(across)}
            c += across
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(1, 4), st.integers(1, 4)), max_size=5), min_size=1, max_size=6))
def test_cells_stand_in_the_columns_of_a_grid(rows):
    """One header row of single cells gives every column a place; each cell then begins at its column's place."""
    wide = max([c + a for (r, c), (a, d) in zip(grid_by_hand(rows), [x for row in rows for x in row])], default=0)
    if not wide:
        return
    head = "<tr>" + "".join(f"<td>H{c:02d}" for c in range(wide))
    body = "".join("<tr>" + "".join(f"<td colspan={a} rowspan={d}>x" for a, d in row) for row in rows)
    lines = visible_text(f"<table>{head}{body}</table>").split("\n")
    places = {c: lines[0].index(f"H{c:02d}") for c in range(wide)}
    found = [i for line in lines[1:] for i, ch in enumerate(line) if ch == "x"]
    assert found == [places[c] for _, c in grid_by_hand(rows)]


@pytest.mark.parametrize("html, text", [
    ("<form>Name <input value=Ann> <input type=submit value=Send><input type=hidden value=no><input type=password value=no></form>", "Name Ann Send"),
    ("<input placeholder='Search here'> <input type=checkbox value=no> yes <input type=image alt=Go>", "Search here yes Go"),
    ("<style>.off{display:none} #gone, p.x { color:red; visibility:hidden }</style><p class='a off'>no</p><p id=gone>no</p><p class=x>no</p><p>yes</p>", "yes"),
    ("<style>.a{display:none} .a{display:block}</style><p class=a>yes</p>", "yes"),
    ("<style>p{display:none} .a{display:block}</style><p class=a>yes</p><p>no</p>", "yes"),
    ("<style>.a{display:none}</style><p class=a style='display:block'>yes</p>", "yes"),
    ("<style>@media print{.a{display:none} p{display:none}} div .b{display:none} .c:hover{display:none}</style><p class=a>a</p><p class=b>b</p><p class=c>c</p>", "a\n\nb\n\nc"),
    ("<style media=print>p{display:none}</style><p>yes", "yes"),
    ("<style>/* p{display:none} */ .v{visibility:hidden} .w{visibility:visible}</style><div class=v>no <b class=w>yes</b></div>", "yes"),
    ("<noscript><style>p{display:none}</style></noscript><p>yes</p>", "yes"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", "- a\n  - b\n- c"),
    ("<ol><li>a<ol><li>b<dl><dt>t<dd>d</dl></ol></ol><p>x", "1. a\n   1. b\n      t\n          d\n\nx"),
    ("a<plaintext>b<b>c</b>", "a\n\nb<b>c</b>"),
    ("<style>", ""), ("<style>.a{display:none", ""),
])
def test_what_a_reader_sees(html, text):
    assert visible_text(html) == text
