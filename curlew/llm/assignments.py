"""Name-literal pairs of source and configuration text.

``pairs`` scans a text once. A target is a name, a path of names and subscripts
(``config["auth"]["pwd"]``), a quoted key, a tag, or what follows ``#define`` or ``ENV``;
after it come a type annotation, an operator and an expression. By family:

- assignments and mappings: ``a = e``, ``a := e``, ``a: e``, ``"a": e``, ``a => e``,
  ``a: str = e``, ``var a string = e``, keyword arguments;
- calls: ``setA(e)``, and ``put("a", e)`` with a quoted name first;
- directives: ``#define A e``, ``ENV A e``;
- tags: ``<a>text</a>``, and ``<add key="a" value="text"/>``;
- block scalars: ``a: |`` and the deeper indented lines, each of which is a literal.

An expression is made of literals (also with a prefix, over several lines, in
parentheses, brackets or backquotes), names, and joins of these; a literal goes through
calls that only change its form, and is the default of a look-up. Comments between the
parts are skipped; pairs inside comments count as others do. Parentheses nest 40 deep.

``flows`` resolves names to a fixed point, so a constant may be bound after its use: a name
means the bindings of the innermost scope around it (bodies of ``def`` and ``class``, braces)
that binds it, else every binding of that name. Keyword arguments bind nothing.
Every step is linear in the text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

_NAME = r"[A-Za-z_$][\w$]*(?:(?:\.|->|::|-)[A-Za-z_$][\w$]*)*"
_KEY = r"""(?:"[A-Za-z_][\w .-]*"|'[A-Za-z_][\w .-]*')"""
_HEAD = re.compile(rf"""(?x)
    (?P<line>\n(?P<indent>[ \t]*)(?P<scope>(?:async[ ]+)?(?:def|class)[ ])?)
  | (?<!\w)(?:\#[ \t]*define|ENV|ARG|setenv|setx)[ \t]+(?P<directive>[A-Za-z_]\w*)[ \t]+(?=["'\w(])
  | <(?P<tag>[A-Za-z_][\w.:-]*)>(?P<inner>[^<>]*)</(?P=tag)>
  | <[A-Za-z][\w.:-]*[ \t]+(?P<attributes>[^<>]*)>
  | (?<![\w$.-])(?:var|const)[ \t]+(?P<first>[A-Za-z_]\w*)[ \t]+(?P<second>\*?[A-Za-z_]\w*)[ \t]*=(?!=)
  | (?:(?<![\w$.-])(?P<name>{_NAME})|(?P<key>{_KEY}))
    (?P<subscripts>(?:\[[ ]*(?:{_KEY}|[\w ]*)[ ]*\])*)[ \t]*
    (?:(?P<op>:=|=>|\?\?=|\|\|=|\+=|[:=](?![=:]))|(?P<call>\())
  | (?P<mark>[(){{}}])
""", re.A)
_TYPE = re.compile(r"""[ \t]*[A-Za-z_][\w.]*(?:\[(?:[^\[\]\n=:"']|\[[^\[\]\n=:"']*\])*\]|<(?:[^<>\n=:"']|<[^<>\n=:"']*>)*>)*(?:[ \t]*\|[ \t]*[\w.]+)*\??[ \t]*=(?![=>])""", re.A)
_GAP = re.compile(r"[ \t]*(?:\\?\r?\n[ \t]*(?=[\"'(`]|[A-Za-z]{1,2}[\"']))?")
_INSIDE = re.compile(r"(?:\s+|//[^\n]*|\#[^\n]*|\\\n)*")
_STRING = re.compile(r'''(?:(?P<prefix>[rRbBuUfF]{1,2}|[@$]{1,2}|L)(?=["']))?(?:"""(?P<a>[\s\S]*?)"""|\'\'\'(?P<b>[\s\S]*?)\'\'\'|"(?P<c>(?:[^"\\\n]|\\.)*)"|'(?P<d>(?:[^'\\\n]|\\.)*)'|`(?P<e>[^`]*)`)''')
_BARE = re.compile(r"[A-Za-z0-9+/_.$-]+=*", re.A)
_JOIN = re.compile(r"[ \t]*(?:\+(?![+=])|\|\||\?\?|\.\.|or\b|(?<=[ \"'])\.(?=[ \"'])|&(?=[ \t]))[ \t]*")
_BLOCK = re.compile(r"[ \t]*[|>][+-]?\d*[+-]?[ \t]*(?:\#[^\n]*)?\r?\n")
_LINE = re.compile(r"([ \t]*)([^\n]*)(?:\n|\Z)")
_FIELD = re.compile(r"\{([^{}]*)\}")
_ATTRIBUTE = re.compile(r"""([A-Za-z_][\w.:-]*)[ \t]*=[ \t]*(?:"([^"<>]*)"|'([^'<>]*)')""", re.A)
_QUOTED = re.compile(r"""["']([^"'\[\]]*)["']""")
_DEPTH = 40

# Calls whose result is their argument in another form, and look-ups with a default.
_FORMS = {"b64decode", "b64encode", "bytes", "bytearray", "decode", "encode", "frombase64", "from", "quote", "secretstr", "str", "string", "strip", "trim", "unhexlify", "fromhex"}
_LOOKUPS = {"get", "getenv", "getproperty", "getordefault", "setdefault", "env", "pop"}
# Names that say nothing themselves, so that of the object around them counts.
_GENERIC = {"content", "data", "default", "literal", "string", "text", "val", "value"}


class Pair(NamedTuple):
    name: str
    scope: int
    literals: list[tuple[int, int]]
    refs: list[tuple[str, tuple[int, int] | None]]  # names, and where they are literals if nothing binds them
    binds: bool


class _Scanner:
    def __init__(self, text: str):
        self.text = text
        self.no_comment_end = len(text) + 1

    def skip(self, at: int, inside: bool) -> int:
        """Past white space and comments."""
        while True:
            at = _INSIDE.match(self.text, at).end() if inside else _GAP.match(self.text, at).end()
            if not self.text.startswith("/*", at) or at >= self.no_comment_end:
                return at
            end = self.text.find("*/", at + 2)
            if end < 0:
                self.no_comment_end = at
                return at
            at = end + 2

    def operand(self, at: int, depth: int, literals: list, refs: list) -> int:
        """The end of the operand at ``at``, or ``at`` where there is none."""
        text = self.text
        if m := _STRING.match(text, at):
            kind = m.lastgroup if m.lastgroup != "prefix" else "c"
            a, b = m.span(kind)
            if kind in "ab":
                whole = text[a:b]
                a, b = a + len(whole) - len(whole.lstrip()), b - len(whole) + len(whole.rstrip())
            if "f" in (m["prefix"] or "").lower() or m["prefix"] == "$":
                for field in _FIELD.finditer(text, a, b):
                    refs.append((field[1].strip().partition("!")[0], None))
                    if field.start() > a:
                        literals.append((a, field.start()))
                    a = field.end()
            if b > a:
                literals.append((a, b))
            return m.end()
        if text.startswith(("(", "["), at) and depth < _DEPTH:
            return self.inside(at + 1, ")" if text[at] == "(" else "]", depth + 1, literals, refs)
        m = _BARE.match(text, at)
        if not m:
            return at
        if text.startswith("(", m.end()):
            call = m[0].rpartition(".")[2].lower()
            if depth < _DEPTH and call in _FORMS:
                return self.inside(m.end() + 1, ")", depth + 1, literals, refs)
            if depth < _DEPTH and call in _LOOKUPS:
                return self.inside(m.end() + 1, ")", depth + 1, literals, refs, first=False)
            return m.end()
        if text.startswith(("[", "{"), m.end()) or m[0] == "new":
            space = self.skip(m.end(), False)
            return self.operand(space, depth + 1, literals, refs) if m[0] == "new" and depth < _DEPTH and space > m.end() else m.end()
        refs.append((m[0], m.span() if any(c.isdigit() for c in m[0]) else None))
        return m.end()

    def inside(self, at: int, close: str, depth: int, literals: list, refs: list, first: bool = True) -> int:
        """Operands up to ``close``, over lines; ``first``: whether those before the first comma count."""
        counted = first
        while True:
            at = self.skip(at, True)
            if self.text.startswith(close, at):
                return at + 1
            if self.text.startswith(",", at):
                counted, at = True, at + 1
                continue
            if j := _JOIN.match(self.text, at):
                at = j.end()
                continue
            end = self.operand(at, depth, *((literals, refs) if counted else ([], [])))
            if end == at:
                return at
            at = end

    def expression(self, at: int, literals: list, refs: list) -> int:
        """Operands joined on one line, or over lines in parentheses."""
        at = self.skip(at, False)
        end = self.operand(at, 0, literals, refs)
        while end > at:
            at = end
            gap = self.skip(at, False)
            if (m := _STRING.match(self.text, gap)) and self.text[at - 1] in "\"'" and gap > at:
                end = self.operand(gap, 0, literals, refs)
            elif m := _JOIN.match(self.text, at):
                to = self.skip(m.end(), True)
                end = self.operand(to, 0, literals, refs)
                end = at if end == to else end
            else:
                break
        return at

    def block(self, at: int, indent: int) -> tuple[list[tuple[int, int]], int]:
        """The lines of a block scalar that are indented deeper than its key, and its end."""
        found = []
        while at < len(self.text):
            m = _LINE.match(self.text, at)
            body = m[2].rstrip()
            if body and len(m[1]) <= indent:
                break
            if body:
                found.append((m.start(2), m.start(2) + len(body)))
            at = m.end()
        return found, at


def _joined(around: str, name: str) -> str:
    """A name that says nothing is called by the object around it, too."""
    return f"{around}.{name}" if around and re.split(r"[.:>-]", name)[-1].lower() in _GENERIC else name


def pairs(text: str) -> tuple[list[Pair], list[int]]:
    """The pairs of a text in order, and the parent of each scope (scope 0 is the text)."""
    text = "\n" + text
    scan = _Scanner(text)
    out: list[Pair] = []
    parents = [0]
    braces: list[tuple[int, str]] = []  # scope to go back to, name of the object around
    bodies: list[tuple[int, int]] = []  # indentation of def or class, scope to go back to
    scope, indent, depth, at, pending = 0, 0, 0, 0, ""

    def opened() -> int:
        parents.append(scope)
        return len(parents) - 1

    def add(name, literals, refs, binds):
        if literals or refs:
            out.append(Pair(_joined(braces[-1][1] if braces else "", name), scope, [(a - 1, b - 1) for a, b in literals],
                            [(r, (s[0] - 1, s[1] - 1) if s else None) for r, s in refs], binds))

    while m := _HEAD.search(text, at):
        at = m.end()
        literals: list = []
        refs: list = []
        if m["line"]:
            follows = text[at:at + 1]
            if follows in ("\n", "\r"):
                depth = 0
            elif follows:
                indent = len(m["indent"])
                if not depth:
                    while bodies and indent <= bodies[-1][0]:
                        scope = bodies.pop()[1]
                if m["scope"]:
                    bodies.append((indent, scope))
                    scope = opened()
        elif m["mark"]:
            if m["mark"] == "{":
                braces.append((scope, pending))
                scope = opened()
            elif m["mark"] == "}":
                if braces:
                    scope = braces.pop()[0]
            else:
                depth = max(0, depth + (1 if m["mark"] == "(" else -1))
            pending = ""
        elif m["directive"]:
            at = scan.expression(at, literals, refs)
            add(m["directive"], literals, refs, True)
        elif m["tag"]:
            inner = m["inner"]
            a = m.start("inner") + len(inner) - len(inner.lstrip())
            add(m["tag"], [(a, a + len(inner.strip()))] if inner.strip() else [], [], False)
        elif m["attributes"] is not None:
            given = {x[1].lower(): x for x in _ATTRIBUTE.finditer(text, m.start("attributes"), m.end("attributes"))}
            for x in given.values():
                add(x[1], [x.span(2 if x[2] is not None else 3)], [], False)
            named = next((given[k] for k in ("key", "name", "id") if k in given), None)
            if named and "value" in given:
                x = given["value"]
                add(named[2] or named[3] or "", [x.span(2 if x[2] is not None else 3)], [], False)
        elif m["first"]:
            at = scan.expression(at, literals, refs)
            add(m["first"], literals, refs, True)
            add(m["second"].lstrip("*"), literals, refs, True)
        else:
            name = ".".join([(m["name"] or m["key"][1:-1]).replace("->", "."), *_QUOTED.findall(m["subscripts"])])
            if m["call"]:
                start = scan.skip(at, True)
                key = _STRING.match(text, start)
                after = scan.skip(key.end(), True) if key else start
                if key and text.startswith(",", after) and (word := key["c"] or key["d"]):
                    # put("name", value): the name is the first argument
                    to = scan.skip(after + 1, True)
                    end = scan.operand(to, 0, literals, refs)
                    if m["name"] and not re.search(r"(?i)(?:get|pop|env)$", m["name"]):
                        add(word, literals, refs, False)
                    at, literals, refs = max(end, after + 1), [], []
                else:
                    # a keyword argument is a pair of its own
                    if not re.match(rf"{_NAME}[ \t]*=(?!=)", text[start:start + 200]):
                        at = scan.expression(at, literals, refs)
                    add(name, literals, refs, False)
                depth += 1
                continue
            if m["op"] == ":" and (block := _BLOCK.match(text, at)):
                literals, at = scan.block(block.end(), indent)
                at -= text[at - 1] == "\n"  # the next line begins there
            else:
                if m["op"] == ":" and (annotated := _TYPE.match(text, at)):
                    at = annotated.end()
                at = scan.expression(at, literals, refs)
            pending = name if text.startswith("{", scan.skip(at, True)) else ""
            add(name, literals, refs, not depth)
    return out, parents


def flows(found: list[Pair], parents: list[int], weight: Callable[[str], float]) -> dict[tuple[int, int], float]:
    """The literals that reach a name with a weight, each with the largest one it reaches."""
    bound: dict[tuple[int, str], list[int]] = {}
    by_name: dict[str, list[int]] = {}
    for i, pair in enumerate(found):
        if pair.binds:
            bound.setdefault((pair.scope, pair.name), []).append(i)
            by_name.setdefault(pair.name, []).append(i)

    def meant(scope: int, name: str):
        """The key of the bindings that a name means, or None."""
        if name not in by_name:
            return None
        while (scope, name) not in bound:
            if not scope:
                return -1, name
            scope = parents[scope]
        return scope, name

    best: dict[tuple[int, int], float] = {}
    seen: set = set()
    done: set[int] = set()
    for w, i in sorted(((weight(p.name), i) for i, p in enumerate(found)), key=lambda x: (-x[0], x[1])):
        if w <= 0:
            break
        todo = [i]
        while todo:
            i = todo.pop()
            if i in done:
                continue
            done.add(i)
            pair = found[i]
            for span in pair.literals:
                best.setdefault(span, w)
            for name, span in pair.refs:
                key = meant(pair.scope, name)
                if key is None:
                    if span:
                        best.setdefault(span, w)
                elif key not in seen:
                    seen.add(key)
                    todo += by_name[name] if key[0] < 0 else bound[key]
    return best


def literals_of(text: str, weight: Callable[[str], float], mark: Callable[[str], bool]) -> Iterator[tuple[tuple[int, int], float, bool]]:
    """(span, weight, whether it reaches a name that ``mark`` accepts) of the literals with a weight."""
    found, parents = pairs(text)
    marked = flows(found, parents, lambda name: 1.0 if mark(name) else 0.0)
    for span, w in flows(found, parents, weight).items():
        yield span, w, span in marked
