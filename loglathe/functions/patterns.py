"""Named log patterns and their expansion into one Java regular expression.

A template such as ``%{TIMESTAMP_ISO8601:timestamp} %{WORD:level}`` is expanded once, on the driver, when
the plan is built.  Executors only ever see the finished regex as a literal inside a Catalyst expression.

Template syntax
    ``%{NAME}``             match the named pattern
    ``%{NAME:field}``       match it and keep the text as ``field``
    ``%{NAME:field:type}``  same, and declare a type (string, int, long, boolean, double)
    ``(?<field>regex)``     inline capture
    anything else           plain Java regex text
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

from loglathe.functions.casts import spark_type

MAX_TEMPLATE_LENGTH = 1000

# The public, widely used named patterns. They match what the published ones match, but repeat no group
# without a bound unless it is possessive: Java recurses once per repetition of a group, and one long line could then
# overflow the stack and take the executor with it.
NAMED_PATTERNS: dict[str, str] = {
    # words, numbers
    "USERNAME": r"[a-zA-Z0-9._-]+",
    "USER": r"%{USERNAME}",
    "INT": r"(?:[+-]?(?:[0-9]+))",
    "BASE10NUM": r"(?<![0-9.+-])(?>[+-]?(?:(?:[0-9]+(?:\.[0-9]+)?)|(?:\.[0-9]+)))",
    "NUMBER": r"(?:%{BASE10NUM})",
    "POSINT": r"\b(?:[1-9][0-9]*)\b",
    "NONNEGINT": r"\b(?:[0-9]+)\b",
    "WORD": r"\b\w+\b",
    "NOTSPACE": r"\S+",
    "SPACE": r"\s*",
    "DATA": r".*?",
    "GREEDYDATA": r".*",
    "QUOTEDSTRING": r"""(?>(?<!\\)(?>"(?>\\.|[^\\"]+)++"|""|(?>'(?>\\.|[^\\']+)++')|''))""",
    "QS": r"%{QUOTEDSTRING}",
    # network
    "IPV4": (
        r"(?<![0-9])(?:(?:25[0-5]|2[0-4][0-9]|[0-1]?[0-9]{1,2})[.](?:25[0-5]|2[0-4][0-9]|[0-1]?[0-9]{1,2})[.]"
        r"(?:25[0-5]|2[0-4][0-9]|[0-1]?[0-9]{1,2})[.](?:25[0-5]|2[0-4][0-9]|[0-1]?[0-9]{1,2}))(?![0-9])"
    ),
    "IPV6": (
        r"(?:(?:(?:[0-9A-Fa-f]{1,4}:){7}(?:[0-9A-Fa-f]{1,4}|:))"
        r"|(?:(?:[0-9A-Fa-f]{1,4}:){6}(?::[0-9A-Fa-f]{1,4}|%{IPV4}|:))"
        r"|(?:(?:[0-9A-Fa-f]{1,4}:){5}(?:(?:(?::[0-9A-Fa-f]{1,4}){1,2})|:%{IPV4}|:))"
        r"|(?:(?:[0-9A-Fa-f]{1,4}:){4}(?:(?:(?::[0-9A-Fa-f]{1,4}){1,3})|(?:(?::[0-9A-Fa-f]{1,4})?:%{IPV4})|:))"
        r"|(?:(?:[0-9A-Fa-f]{1,4}:){3}(?:(?:(?::[0-9A-Fa-f]{1,4}){1,4})|(?:(?::[0-9A-Fa-f]{1,4}){0,2}:%{IPV4})|:))"
        r"|(?:(?:[0-9A-Fa-f]{1,4}:){2}(?:(?:(?::[0-9A-Fa-f]{1,4}){1,5})|(?:(?::[0-9A-Fa-f]{1,4}){0,3}:%{IPV4})|:))"
        r"|(?:(?:[0-9A-Fa-f]{1,4}:){1}(?:(?:(?::[0-9A-Fa-f]{1,4}){1,6})|(?:(?::[0-9A-Fa-f]{1,4}){0,4}:%{IPV4})|:))"
        r"|(?::(?:(?:(?::[0-9A-Fa-f]{1,4}){1,7})|(?:(?::[0-9A-Fa-f]{1,4}){0,5}:%{IPV4})|:)))(?:%.+)?"
    ),
    "IP": r"(?:%{IPV6}|%{IPV4})",
    # a name has at most 127 labels
    "HOSTNAME": r"\b(?:[0-9A-Za-z][0-9A-Za-z-]{0,62})(?:\.(?:[0-9A-Za-z][0-9A-Za-z-]{0,62})){0,126}(?:\.?|\b)",
    "IPORHOST": r"(?:%{HOSTNAME}|%{IP})",
    # IPORHOST where a blank must follow: no label is given back, since none could be followed by a blank, and once a name
    # and its blank are found an address is not tried, since it would be the same text
    "BLANKHOST": (
        r"(?>\b[0-9A-Za-z][0-9A-Za-z-]{0,62}+(?:\.[0-9A-Za-z][0-9A-Za-z-]{0,62}+)*+(?:\.?|\b)(?= )|%{IP}(?= ))"
    ),
    "URIPROTO": r"[A-Za-z]+(?:\+[A-Za-z+]+)?",
    "URIHOST": r"%{IPORHOST}(?::%{POSINT})?",
    "URIPATH": r"/[A-Za-z0-9$.+!*'(){},~:;=@#%_\-/]*",
    "URIPARAM": r"\?[A-Za-z0-9$.+!*'|(){},~@#%&/=:;_?\-\[\]]*",
    "URIPATHPARAM": r"%{URIPATH}(?:%{URIPARAM})?",
    "URI": r"%{URIPROTO}://(?:%{USER}(?::[^@]*)?@)?(?:%{URIHOST})?(?:%{URIPATHPARAM})?",
    # dates and times
    "MONTH": (
        r"\b(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?"
        r"|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)\b"
    ),
    "MONTHNUM": r"(?:0?[1-9]|1[0-2])",
    "MONTHDAY": r"(?:(?:0[1-9])|(?:[12][0-9])|(?:3[01])|[1-9])",
    "YEAR": r"(?>\d\d){1,2}",
    "HOUR": r"(?:2[0123]|[01]?[0-9])",
    "MINUTE": r"(?:[0-5][0-9])",
    "SECOND": r"(?:(?:[0-5][0-9]|60)(?:[:.,][0-9]+)?)",
    "TIME": r"%{HOUR}:%{MINUTE}(?::%{SECOND})(?![0-9])",
    "ISO8601_TIMEZONE": r"(?:Z|[+-]%{HOUR}(?::?%{MINUTE}))",
    "TIMESTAMP_ISO8601": r"%{YEAR}-%{MONTHNUM}-%{MONTHDAY}[T ]%{HOUR}:?%{MINUTE}(?::?%{SECOND})?%{ISO8601_TIMEZONE}?",
    "HTTPDATE": r"%{MONTHDAY}/%{MONTH}/%{YEAR}:%{TIME} %{INT}",
    "SYSLOGTIMESTAMP": r"%{MONTH} +%{MONTHDAY} %{TIME}",
    # log lines
    "LOGLEVEL": (
        r"(?:[Aa]lert|ALERT|[Tt]race|TRACE|[Dd]ebug|DEBUG|[Nn]otice|NOTICE|[Ii]nfo|INFO|[Ww]arn?(?:ing)?|WARN?(?:ING)?"
        r"|[Ee]rr?(?:or)?|ERR?(?:OR)?|[Cc]rit?(?:ical)?|CRIT?(?:ICAL)?|[Ff]atal|FATAL|[Ss]evere|SEVERE"
        r"|EMERG(?:ENCY)?|[Ee]merg(?:ency)?)"
    ),
    "PROG": r"(?:[\w._/%-]+)",
    "SYSLOGPROG": r"%{PROG:program}(?:\[%{POSINT:pid}\])?",
    "SYSLOGHOST": r"%{IPORHOST}",
    "SYSLOGFACILITY": r"<%{NONNEGINT:facility}.%{NONNEGINT:priority}>",
    "SYSLOGBASE": r"%{SYSLOGTIMESTAMP:timestamp} (?:%{SYSLOGFACILITY} )?%{BLANKHOST:logsource} %{SYSLOGPROG}:",
    "COMMONAPACHELOG": (
        r"%{BLANKHOST:clientip} %{USER:ident} %{USER:auth} \[%{HTTPDATE:timestamp}\] "
        r'"(?:%{WORD:verb} %{NOTSPACE:request}(?: HTTP/%{NUMBER:httpversion})?|%{DATA:rawrequest})" '
        r"%{NUMBER:response} (?:%{NUMBER:bytes}|-)"
    ),
    # The documented sample of this pattern has no referrer and agent, so both are optional here.
    "COMBINEDAPACHELOG": r"%{COMMONAPACHELOG}(?: %{QS:referrer} %{QS:agent})?",
}

_REFERENCE = re.compile(r"%\{(?P<name>\w+)(?::(?P<field>\w+)(?::(?P<type>\w+))?)?\}")
_INLINE = re.compile(r"\(\?<(?P<field>[A-Za-z]\w*)>")


@dataclass(frozen=True)
class Capture:
    """One captured field: where the regex keeps it and how it is typed."""

    name: str
    groups: tuple[int, ...]  # 1-based group numbers; more than one when alternatives share a name
    optional: bool  # the group may take no part in a match, so '' means "absent"
    type_name: str | None = None


@dataclass(frozen=True)
class CompiledPattern:
    template: str
    regex: str
    captures: tuple[Capture, ...]
    group_count: int = field(default=0)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.captures]

    @property
    def declared_types(self) -> dict[str, str]:
        return {c.name: c.type_name for c in self.captures if c.type_name}


def compile_pattern(template: str, custom: dict[str, str] | None = None) -> CompiledPattern:
    """Expand ``template`` into a Java regex; unknown names, loops and field-less templates raise here."""
    return _compile(template, tuple(sorted((custom or {}).items())))


@lru_cache(maxsize=256)
def _compile(template: str, custom: tuple[tuple[str, str], ...]) -> CompiledPattern:
    if not template or len(template) > MAX_TEMPLATE_LENGTH:
        raise ValueError(f"Pattern length must be between 1 and {MAX_TEMPLATE_LENGTH} characters")
    table = {**NAMED_PATTERNS, **dict(custom)}
    slots: list[tuple[str, str | None]] = []

    def open_capture(name: str, type_name: str | None) -> str:
        if type_name is not None:
            spark_type(type_name)  # raises for a type we do not know
        slots.append((name, type_name))
        return f"(?<f{len(slots) - 1}>"

    def expand(text: str, trail: tuple[str, ...]) -> str:
        text = _INLINE.sub(lambda m: open_capture(m["field"], None), text)

        def replace(match: re.Match) -> str:
            name = match["name"]
            if name not in table:
                raise ValueError(f"Unknown pattern name: {name}")
            if name in trail:
                raise ValueError(f"Pattern {name} refers to itself")
            head = open_capture(match["field"], match["type"]) if match["field"] else "(?:"
            return head + expand(table[name], (*trail, name)) + ")"

        return _REFERENCE.sub(replace, text)

    regex = expand(template, ())
    if not slots:
        raise ValueError(f"Pattern captures no field: {template}")
    return _describe(template, regex, slots)


def _describe(template: str, regex: str, slots: list[tuple[str, str | None]]) -> CompiledPattern:
    """Number the capture groups and find those that a match may leave out."""
    groups, total = _scan_groups(regex)
    order: list[str] = []
    numbers: dict[str, list[int]] = {}
    optional: dict[str, bool] = {}
    types: dict[str, str | None] = {}
    for slot, (name, type_name) in enumerate(slots):
        if f"f{slot}" not in groups:
            raise ValueError(f"Can't tell the fields of this pattern apart (a comment?): {template}")
        number, may_be_absent = groups[f"f{slot}"]
        if name not in numbers:
            order.append(name)
            numbers[name], optional[name], types[name] = [], False, None
        numbers[name].append(number)
        optional[name] = optional[name] or may_be_absent or len(numbers[name]) > 1
        types[name] = types[name] or type_name
    order.sort(key=lambda n: numbers[n][0])
    captures = tuple(Capture(n, tuple(numbers[n]), optional[n], types[n]) for n in order)
    return CompiledPattern(template, regex, captures, total)


def _scan_groups(regex: str) -> tuple[dict[str, tuple[int, bool]], int]:
    """Map our group names to (number, optional). Optional = inside ``(..)?``, ``(..)*``, ``{0,`` or an alternation."""
    stack: list[dict] = [{"name": None, "number": 0, "alternation": False, "inner": []}]
    found: dict[str, tuple[int, bool]] = {}
    count = 0
    i = 0
    while i < len(regex):
        ch = regex[i]
        if regex.startswith("\\Q", i):
            quoted = regex.find("\\E", i)
            i = len(regex) if quoted < 0 else quoted + 2
            continue
        if ch == "\\":
            i += 2
            continue
        if ch == "[":
            i = _skip_class(regex, i)
            continue
        if ch == "(":
            named = re.match(r"\(\?<([A-Za-z]\w*)>", regex[i:])
            capturing = named is not None or not regex.startswith("(?", i)
            count += capturing
            name = named[1] if named else None
            stack.append({"name": name, "number": count, "alternation": False, "inner": []})
            i += len(named[0]) if named else 1
            continue
        if ch == "|":
            stack[-1]["alternation"] = True
        elif ch == ")":
            group = stack.pop()
            # a group may be left out when it is repeated zero times; its alternatives may each be left out
            skipped = regex[i + 1 : i + 2] in ("?", "*") or regex.startswith("{0", i + 1)
            inner = [(n, k, o or skipped or group["alternation"]) for n, k, o in group["inner"]]
            if group["name"]:
                inner.append((group["name"], group["number"], skipped))
            stack[-1]["inner"].extend(inner)
        i += 1
    top = stack[0]
    for name, number, opt in top["inner"]:
        found[name] = (number, opt or top["alternation"])
    return found, count


def _skip_class(regex: str, start: int) -> int:
    """Index just after the character class that opens at ``start`` (classes may nest in Java)."""
    depth, i = 0, start
    while i < len(regex):
        if regex[i] == "\\":
            i += 2
            continue
        if regex[i] == "[":
            depth += 1
            if regex[i + 1 : i + 2] == "^":
                i += 1
            if regex[i + 1 : i + 2] == "]":
                i += 1
        elif regex[i] == "]":
            depth -= 1
            if depth == 0:
                return i + 1
        i += 1
    raise ValueError("Unclosed character class in pattern")
