"""One walk over a stored page that returns the text nodes of all wanted elements.

Only collecting happens here, inside a task; trimming, fall-backs and classification are column
expressions on the result. A wanted element is described by a chain of ``Step``s, each a
descendant of the one before.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterable
from typing import NamedTuple


class Step(NamedTuple):
    """One element test: tag name, class token, part of the class text, place among siblings."""

    tag: str | None = None
    cls: str | None = None
    cls_part: str | None = None
    nth: int | None = None


class Field(NamedTuple):
    """What to collect.

    kind ``texts``     direct text nodes of all matched elements, in document order
    kind ``attr``      value of attribute ``arg`` of each matched element
    kind ``elements``  per matched element its direct text nodes and its whole text
    kind ``pairs``     per matched element the first text of the key and of the value element in
                       it, ``arg`` = (key step, value step)
    """

    name: str
    kind: str
    chains: tuple
    arg: object = None


# HTML facts (fixed values).
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
        "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form",
         "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre",
         "section", "table", "ul"}
# elements that end without an end tag, and the elements their scope does not reach into
SCOPES = {
    "p": {"table", "td", "th", "button"},
    "li": {"ul", "ol"},
    "dt": {"dl"}, "dd": {"dl"},
    "option": {"select"},
    "tr": {"table"},
    "td": {"table", "tr"}, "th": {"table", "tr"},
}
BOUNDARIES = set().union(*SCOPES.values())
# start tag -> open elements it ends
ENDS = {tag: ("p",) for tag in BLOCK} | {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr",),
    "td": ("td", "th"), "th": ("td", "th"),
}
# an end tag of another kind does not close these
CONTAINERS = (BLOCK - {"p"}) | {"li", "td", "th", "tr", "body", "html"}

# Comment, script, style, tag, anything else in angle brackets; splitting at it gives texts and
# tokens in turn. What is never closed ends at the next '<' or takes all the rest, so that broken
# pages are read in linear time too.
_TOKEN = re.compile(
    r"(<!--.*?(?:-->|\Z)"
    r"|<script\b[^<>]*>.*?(?:</script\s*>|\Z)"
    r"|<style\b[^<>]*>.*?(?:</style\s*>|\Z)"
    r"|</?[a-z](?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
    r"|<[!?][^<>]*>)",
    re.S | re.I,
)
_NAME = re.compile(r"</?([a-z][^\s/>]*)", re.I)
_ATTR = re.compile(
    r"(?<![^\s=/\"'<>])([^\s=/\"'<>]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTR.findall(text):
        value = double or single or bare
        found.setdefault(name.lower(), _html.unescape(value) if "&" in value else value)
    return found


class _Open:
    """An element whose end has not been seen."""

    __slots__ = ("tag", "children", "states", "sinks", "deep", "groups", "scope", "inline")

    def __init__(self, tag, states, sinks, deep, groups):
        self.tag = tag
        self.children = 0
        self.states = states    # steps already satisfied, per chain
        self.sinks = sinks      # lists that take the direct text
        self.deep = deep        # lists that take the text of all descendants
        self.groups = groups    # open key/value records, as (field name, (keys, values))
        # set when pushed:
        # scope             depth of the open elements that may end without an end tag
        # inline            number of open elements by tag since the last container


class _Stack:
    """The open elements. Each is pushed and popped once, and no search is longer than what it
    pops."""

    def __init__(self, root: _Open):
        root.scope, root.inline = {}, {}
        self.elements = [root]
        self.containers: dict[str, int] = {}

    def push(self, element: _Open) -> None:
        tag, parent = element.tag, self.elements[-1]
        scope = parent.scope
        if scope and tag in BOUNDARIES:
            scope = {k: depth for k, depth in scope.items() if tag not in SCOPES[k]}
        if tag in SCOPES:
            scope = {**scope, tag: len(self.elements)}
        element.scope = scope
        if tag in CONTAINERS:
            element.inline = {}
            counts = self.containers
        else:
            element.inline = counts = parent.inline
        counts[tag] = counts.get(tag, 0) + 1
        self.elements.append(element)

    def pop_to(self, depth: int) -> _Open:
        """Drop the elements from that depth on; the new top is returned."""
        elements = self.elements
        while len(elements) > depth:
            gone = elements.pop()
            counts = self.containers if gone.tag in CONTAINERS else gone.inline
            counts[gone.tag] -= 1
        return elements[-1]

    def closed_by(self, tag: str) -> int:
        """Depth of the element an end tag closes, 0 if there is none. The end of an inline
        element does not close a container."""
        elements = self.elements
        depth = len(elements) - 1
        if elements[depth].tag == tag:
            return depth
        counts = self.containers if tag in CONTAINERS else elements[depth].inline
        if not counts.get(tag):
            return 0
        while elements[depth].tag != tag:
            depth -= 1
        return depth

    def ended_by(self, tags: tuple[str, ...]) -> int:
        """Depth of the innermost element that one of the tags in scope ends, 0 if none."""
        scope = self.elements[-1].scope
        if not scope:
            return 0
        return max([scope.get(t, 0) for t in tags])


# kinds of token
_OTHER, _RAW, _END, _START = range(4)


class _Token:
    """What a token means, whatever surrounds it."""

    __slots__ = ("kind", "tag", "ends", "steps", "parts", "attributes")

    def __init__(self, kind, tag="", ends=None, steps=(), parts=(), attributes=None):
        self.kind = kind
        self.tag = tag
        self.ends = ends                # open elements a start tag ends
        self.steps = steps              # (chain number, step number, wanted place) that fit
        self.parts = parts              # (field name, 0 for key or 1 for value, wanted place)
        self.attributes = attributes


def _fits(step: Step, tag: str, cls_text: str) -> bool:
    return (
        (step.tag is None or step.tag == tag)
        and (step.cls is None or step.cls in cls_text.split())
        and (step.cls_part is None or step.cls_part in cls_text)
    )


class PageWalk:
    """A compiled set of fields; calling it with a page gives {field name: list}."""

    # tokens repeat from page to page, so the short ones are kept, up to a bound
    REMEMBERED = 4096
    SHORT = 200

    def __init__(self, fields: Iterable[Field]):
        self.fields = list(fields)
        self.chains = [(chain, field) for field in self.fields for chain in field.chains]
        self.start = (0,) * len(self.chains)
        self.tokens: dict[str, _Token] = {}
        self.known: dict[tuple[str, str], tuple[list, list]] = {}

    def __call__(self, page: str | None) -> dict[str, list]:
        out: dict[str, list] = {f.name: [] for f in self.fields}
        top = _Open("", self.start, (), (), ())
        stack = _Stack(top)
        text = ""
        pieces = _TOKEN.split(page or "")
        remembered = self.tokens
        for at in range(1, len(pieces), 2):
            before, markup = pieces[at - 1], pieces[at]
            if before:
                text = text + before if text else before
            token = remembered.get(markup) or self._token(markup)
            kind = token.kind
            if kind == _END:
                depth = stack.closed_by(token.tag)
                # an end tag that closes nothing does not split the text around it
                if depth:
                    if text:
                        if top.sinks or top.deep:
                            self._take(top, text)
                        text = ""
                    top = stack.pop_to(depth)
                continue
            if text:
                if top.sinks or top.deep:
                    self._take(top, text)
                text = ""
            if kind == _START:
                if token.ends:
                    depth = stack.ended_by(token.ends)
                    if depth:
                        top = stack.pop_to(depth)
                top.children += 1
                if token.steps or token.parts:
                    opened = self._match(top, token, out)
                else:
                    opened = _Open(token.tag, top.states, (), top.deep, top.groups)
                if token.tag not in VOID:
                    stack.push(opened)
                    top = opened
            elif kind == _RAW:
                top.children += 1
        self._take(top, text + pieces[-1])
        return self._shaped(out)

    def _token(self, markup: str) -> _Token:
        name = _NAME.match(markup)
        if name is None:
            token = _Token(_OTHER)
        else:
            tag = name[1].lower()
            if markup[1] == "/":
                token = _Token(_END, tag)
            elif tag in ("script", "style"):
                token = _Token(_RAW, tag)
            else:
                attributes = _attributes(markup[name.end():-1])
                steps, parts = self._fitting(tag, attributes.get("class", ""))
                token = _Token(_START, tag, ENDS.get(tag), steps, parts, attributes)
        if len(markup) <= self.SHORT:
            self._remember(self.tokens, markup, token)
        return token

    def _fitting(self, tag: str, cls_text: str) -> tuple[list, list]:
        """Steps and key/value parts that a tag with this class fits."""
        known = self.known.get((tag, cls_text))
        if known is None:
            known = (
                [(i, n, step.nth) for i, (chain, _) in enumerate(self.chains)
                 for n, step in enumerate(chain) if _fits(step, tag, cls_text)],
                [(f.name, side, step.nth) for f in self.fields if f.kind == "pairs"
                 for side, step in enumerate(f.arg) if _fits(step, tag, cls_text)],
            )
            self._remember(self.known, (tag, cls_text), known)
        return known

    def _remember(self, memory: dict, key, value) -> None:
        if len(memory) >= self.REMEMBERED:
            memory.clear()
        memory[key] = value

    @staticmethod
    def _take(top: _Open, text: str) -> None:
        if not text:
            return
        if "&" in text:
            text = _html.unescape(text)
        for sink in top.sinks:
            sink.append(text)
        for sink in top.deep:
            sink.append(text)

    def _match(self, parent: _Open, token: _Token, out: dict[str, list]) -> _Open:
        """The opened element, attached to everything it is wanted for."""
        place = parent.children
        states, sinks, deep, groups = parent.states, (), parent.deep, parent.groups
        if groups and token.parts:
            sinks = [record[side] for name, side, nth in token.parts if nth in (None, place)
                     for group, record in groups if group == name]
        taken = ()
        for i, n, nth in token.steps:
            if parent.states[i] != n or nth not in (None, place):
                continue
            chain, field = self.chains[i]
            if n < len(chain) - 1:
                if states is parent.states:
                    states = list(states)
                states[i] = n + 1
            elif field.name not in taken:
                taken = (*taken, field.name)
                collected = out[field.name]
                if field.kind == "texts":
                    sinks = [*sinks, collected]
                elif field.kind == "attr":
                    if field.arg in token.attributes:
                        collected.append(token.attributes[field.arg])
                else:
                    record = ([], [])
                    collected.append(record)
                    if field.kind == "elements":
                        sinks = [*sinks, record[0]]
                        deep = (*deep, record[1])
                    else:
                        groups = (*groups, (field.name, record))
        return _Open(token.tag, states, sinks, deep, groups)

    def _shaped(self, out: dict[str, list]) -> dict[str, list]:
        for field in self.fields:
            if field.kind == "elements":
                out[field.name] = [
                    {"nodes": nodes, "full": "".join(full)} for nodes, full in out[field.name]]
            elif field.kind == "pairs":
                out[field.name] = [
                    {"key": keys[0] if keys else None, "value": values[0] if values else None}
                    for keys, values in out[field.name]]
        return out
