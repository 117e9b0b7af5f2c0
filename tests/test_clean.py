import pytest

from lodestrata.functions import clean as C

CASES = [
    ("plain text stays", "plain text stays"),
    ("a <span id='x'>kept</span> word", "a kept word"),
    ("<SPAN class='a'>two\nlines</SPAN> here", "two\nlines here"),
    ("end<sup>&</sup>lt;sup>3</sup> of", "end of"),
    ("end<sup>&</sup>lt;sup>42</sup> of", "end of"),
    ("end lt;sup>7</sup> of", "end  of"),
    ("a lt; b", "a lt; b"),
    ("x<sup>n</sup>", "x$^{n}$"),
    ("*x<sup>n</sup>*", "*x$^{n}$*"),
    ("v<sup>−</sup>", "v$^{−}$"),
    ("u<sub>i</sub>", "u$_{i}$"),
    ("T<sup>-1</sup>", "T$^{-1}$"),
    ("s<sup>α</sup>", "s$^{α}$"),
    ("note<sup>4</sup>", "note"),
    ("note<sup>17</sup> goes on", "note goes on"),
    ("H<sub>2</sub>O", "H<sub>2</sub>O"),
    ("![](_page_4_Figure_1.jpeg)", ""),
    ("![](_page_12_Picture_0.PNG) Figure 1.", " Figure 1."),
    ("![alt](_page_4_Figure_1.jpeg)", "![alt](_page_4_Figure_1.jpeg)"),
    ("![](https://host.example/a.png)", "![](https://host.example/a.png)"),
    ("a<br/>b<br>c", "a b c"),
    ("a b", "a b"),
    ("co­op", "coop"),
    ("x<sup>far too long for a formula</sup>", "x"),
    ("end\n", "end"),
    ("one\r\ntwo", "one\ntwo"),
]


@pytest.mark.parametrize("given,wanted", CASES)
def test_cases(column, given, wanted):
    assert column(C.clean, given) == wanted


def test_page_numbers_and_headers_go(column):
    text = "Running Title\nfirst text line here\n12\nRunning Title\nsecond\nPage 3 of 9\nRunning Title\nthird $x$\n5 of 7\n10 PRINT A"
    assert column(C.page_artefacts, text) == "first text line here\nsecond\nthird $x$\n10 PRINT A"


def test_frequent_lines_with_formula_signs_stay(column):
    text = "| a | b |\n| a | b |\n| a | b |"
    assert column(C.page_artefacts, text) == text


def test_nulls_and_empty(column):
    assert column(C.clean, None) is None
    assert column(C.clean, "") == ""
