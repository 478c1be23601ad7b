"""Keywords of license rules hide nothing that the expressions find."""

import re

import pytest

from gaugeworks.llm import licenses


def example(parts):
    """A text that a parsed name matches: without what is optional, the first of what has a choice."""
    out = ""
    for kind, value in parts:
        if kind is licenses.sre.LITERAL:
            out += chr(value)
        elif kind is licenses.sre.SUBPATTERN:
            out += example(value[3])
        elif kind is licenses.sre.BRANCH:
            out += example(value[1][0])
        elif kind is licenses.sre.IN:
            out += chr(value[0][1] if value[0][0] is licenses.sre.LITERAL else value[0][1][0])
        elif kind in (licenses.sre.MAX_REPEAT, licenses.sre.MIN_REPEAT):
            out += example(value[2]) * value[0]
        elif kind is licenses.sre.ANY:
            out += "x"
    return out


NAMES = [(label, n.strip().replace(",", "")) for label, _, names in licenses._rows(licenses.NAMES) for n in names.split(";")]


@pytest.mark.parametrize("label, name", NAMES)
def test_each_name_alone_is_found_as_without_keywords(label, name):
    text = example(licenses.parser.parse(name))
    assert re.fullmatch(name, text)
    for whole in (text, f"released under the {text}"):
        joined = f" {whole} "
        found = [(*m.span(), k) for k, r in enumerate(licenses.rules()) for m in r[3].finditer(joined)]
        assert any(licenses.rules()[k][0] == label for _, _, k in found)
        expected = [(licenses.rules()[k][0], licenses.rules()[k][1], a - 1, b - 1) for a, b, k in licenses.suppressed(found)]
        assert [(d["label"], d["tier"], d["start"], d["end"]) for d in licenses.scan(whole.encode())["detections"]] == expected


@pytest.mark.parametrize("number", range(len(licenses.rules())))
def test_every_rule_s_keywords_let_its_own_text_through(number):
    """All rules: names, statements, addresses and notices."""
    label, _, _, expression = licenses.rules()[number]
    text = example(licenses.parser.parse(expression.pattern)).strip()
    assert expression.search(f" {text} ")
    found = licenses.scan(f"{text} ".encode())["detections"]
    covered = [(*m.span(), k) for k, r in enumerate(licenses.rules()) for m in r[3].finditer(f" {text} ")]
    expected = [(licenses.rules()[k][0], licenses.rules()[k][1], a - 1, b - 1) for a, b, k in licenses.suppressed(covered)]
    assert [(d["label"], d["tier"], d["start"], d["end"]) for d in found] == expected and expected


@pytest.mark.parametrize(
    "text, label",
    [
        ("This license governs use of the accompanying software. If you use the software, you accept this license.", "ms-pl"),
        ("AGPLv3", "agpl-3.0"),
        ("AGPL 3.0", "agpl-3.0"),
        ("GNU Public License", "gpl"),
        ("GNU FDL", "gfdl"),
        ("Berkeley Software Distribution License", "bsd"),
        ("Internet Systems Consortium License", "isc"),
        ("PSF License", "python-2.0"),
        ("Ruby's License", "ruby"),
        ("Open RAIL-M", "openrail"),
        ("to deal with the Software without restriction, including without limitation the rights to use, copy", "ncsa"),
    ],
)
def test_forms_without_the_row_s_keyword(text, label):
    assert label in licenses.scan(f"see {text} here".encode())["labels"]
