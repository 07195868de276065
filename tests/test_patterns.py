import pytest

from loglathe.functions.patterns import NAMED_PATTERNS, compile_pattern
from loglathe.plans.formats import FORMATS


def test_fields_in_order_and_group_numbers():
    p = compile_pattern("%{TIMESTAMP_ISO8601:timestamp} %{WORD:level} %{GREEDYDATA:message}")
    assert p.names == ["timestamp", "level", "message"]
    assert [c.groups for c in p.captures] == [(1,), (2,), (3,)]
    assert not any(c.optional for c in p.captures)


def test_optional_parts_are_found():
    p = compile_pattern(r"%{IP:ip} (?:%{USER:user})? (?<tail>a|b)? [(?|]%{DATA:x}(?:(%{INT:n})|-)")
    assert {c.name: c.optional for c in p.captures} == {"ip": False, "user": True, "tail": True, "x": False, "n": True}


def test_plain_groups_of_the_author_shift_numbers_only():
    p = compile_pattern("(a|b)%{INT:n}(c)%{WORD:w}")
    assert [c.groups for c in p.captures] == [(2,), (4,)]


def test_same_name_in_alternatives():
    p = compile_pattern("(?:%{IPV4:addr}|%{WORD:addr})")
    assert p.names == ["addr"] and p.captures[0].groups == (1, 2) and p.captures[0].optional


def test_declared_types():
    p = compile_pattern("%{INT:n:int} %{NUMBER:x:Double} %{WORD:w}")
    assert p.declared_types == {"n": "int", "x": "Double"}
    with pytest.raises(ValueError, match="Unsupported type: decimal"):
        compile_pattern("%{INT:n:decimal}")


@pytest.mark.parametrize(
    ("template", "message"),
    [
        ("%{NO_SUCH:x}", "Unknown pattern name"),
        ("%{WORD} only", "captures no field"),
        ("", "length"),
        ("x" * 1001, "length"),
        ("[abc%{INT:n}", "Unclosed"),
    ],
)
def test_bad_templates_fail_before_anything_runs(template, message):
    with pytest.raises(ValueError, match=message):
        compile_pattern(template)


def test_custom_names_and_loops():
    p = compile_pattern("%{ORDER:id}", {"ORDER": "ord-%{INT}"})
    assert p.names == ["id"]
    with pytest.raises(ValueError, match="refers to itself"):
        compile_pattern("%{A:x}", {"A": "%{B}", "B": "%{A}"})


def test_every_named_pattern_expands():
    for name in NAMED_PATTERNS:
        compile_pattern("%{" + name + ":x}")


def test_presets_have_the_documented_fields():
    assert FORMATS["application"].compiled.names == ["timestamp", "level", "message"]
    assert FORMATS["access"].compiled.names == [
        "clientip", "ident", "auth", "timestamp", "verb", "request", "httpversion", "rawrequest", "response", "bytes",
        "referrer", "agent",
    ]
    assert FORMATS["syslog"].compiled.names == [
        "timestamp", "facility", "priority", "logsource", "program", "pid", "message",
    ]
    assert FORMATS["nginx_error"].compiled.names == ["timestamp", "level", "pid", "message"]
    assert FORMATS["custom_app"].compiled.names == ["timestamp", "level", "service", "message"]


def test_quoted_text_and_comments():
    assert compile_pattern(r"\Q(a)(\E(?<n>[0-9]+)").captures[0].groups == (1,)
    with pytest.raises(ValueError, match="fields of this pattern"):
        compile_pattern("(?x) (?# ( ) (?<n>[0-9]+) # (")
