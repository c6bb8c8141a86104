from __future__ import annotations

import pytest

from corpusmill.functions.markup import has_residue
from corpusmill.functions.wikitext import count_words, normal_lines, plain_text, shown_sections
from corpusmill.operators.cascade import text_reason


@pytest.mark.parametrize(
    "wikitext, text",
    [
        ("[[File:A.jpg|right|200px]] '''Clean''' prose links to [[Useful|useful text]].\n[[Category:X]]\n==References==\nCited.", "Clean prose links to useful text."),
        ("An introduction of useful prose.\n{{table header}}\n|-bgcolor=#fefefe\n| One || Two || align=right | 2 km", "An introduction of useful prose."),
        ("Opening.<ref>\nCited.</ref> More.<ref\nname=\"m\"/> Final.<ref name=http://example.com/>Cited.</ref> Last.<refname=A /> End.", "Opening. More. Final. Last. End."),
        ("Useful.<references>\nlist\n</references> Adjacent.<references />", "Useful. Adjacent."),
        ("Opening stays.\n{| class=\"a\"\n| {| class=\"b\"\n| nested || cells\n|}\n|}\n==References==\nnoise\n==History==\nStays too.", "Opening stays.\n\nHistory\nStays too."),
        ("==Life==\nOpening.\n===References===\nnoise\n====Notes====\nnoise\n===Career===\nResumes.", "Life\nOpening.\nCareer\nResumes."),
        ("Caf&eacute; {{x|{{y}}}}[http://a.example title here] [http://b.example] {{{p|default}}} <b>bold</b> [[A|b [[c]] d]]", "Café title here default bold b c d"),
        ("One __NOTOC__ ''two''.\n! colspan=\"2\" | head\n* item\n----\nline--> ends", "One  two.\nitem\n\nline ends"),
        ("&lt;ref&gt;cited&lt;/ref&gt;Kept words here", "Kept words here"),
        ("", ""),
        ("<nowiki>[[not a link]]</nowiki>", "not a link"),
        ("{{outer|[[File:x.png|thumb|caption]]}}Words stay", "Words stay"),
    ],
)
def test_markup_becomes_prose(wikitext, text):
    assert plain_text(wikitext) == text


@pytest.mark.parametrize(
    "wikitext",
    [
        "{{Infobox country\n| name = Broken\nProse that cannot be told apart.",
        "[[File:A.jpg|thumb|An unclosed caption.\nProse stays ambiguous.",
        "Prose with a dangling close.\n</references>",
        "Opening.\nSpecifications: | style=\"x\" | 42 kg.\nMore prose follows.",
        "A }} closes nothing here",
        "Text with a [//example.org link",
    ],
)
def test_unbalanced_markup_is_rejected(wikitext):
    assert text_reason(plain_text(wikitext)) == "markup_residue"


def test_reasons_of_texts():
    assert text_reason("") == "empty_text"
    assert text_reason("tiny") == "insufficient_text"
    assert text_reason("three words here") is None
    assert count_words("a1b ²c d_e") == 5


@pytest.mark.parametrize(
    "text", ["{{x", "y}}", "[[x", "y]]", "[http://x", "[//x", "< / ref >", "<refname=x", "<gallery", "<NoWiki", "\n {|x", "a | class = x", "''", "<!--", "--!>", "__TOC__"]
)
def test_residue_is_found(text):
    assert has_residue(text)


@pytest.mark.parametrize("text", ["plain", "a'b", "<reference", "x | y", "__a__", "[text]", "{x}", "|class"])
def test_sound_text_has_no_residue(text):
    assert not has_residue(text)


def test_sections_and_lines():
    assert shown_sections("a\n== Notes: ==\nb\n=== Sub ===\nc\n== Next ==\nd") == "a\nNext\nd"
    assert normal_lines("a\t b\r\n\r\n\r\n\r\nc\x0b d ") == "a b\n\nc d"
    assert normal_lines("é") == "é"
    assert normal_lines("a '''' b") == "a  b"


def test_section_skip_as_a_column_equals_the_scanner(spark):
    import random

    from corpusmill.functions.sections import without_boilerplate

    r = random.Random(9)
    lines = ["text", "== Notes ==", "= A =", "=== See also: ===", "==B==", "==== References ====", "====", "=", "=== x ==", "", "======= y ======="]
    texts = ["\n".join(r.choices(lines, k=r.randrange(0, 14))) for _ in range(400)]
    frame = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    got = [row[0] for row in frame.coalesce(1).select(without_boilerplate(frame["t"])).collect()]
    assert got == [shown_sections(t) for t in texts] + [None]
