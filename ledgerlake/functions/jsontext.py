"""Reading JSON text without a nesting limit.

VARIANT parsing stops at some hundred levels; legal call trees go deeper. These helpers
walk the text once with an explicit stack, never recurse, and hand out members as the
very text they were written in.
"""
from __future__ import annotations

import json
import re

_TOKEN = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"|[{}\[\],:]|[^\s{}\[\],:"]+', re.S)


def members(text: str) -> dict[str, str] | None:
    """Top-level members of a JSON object as text; None when `text` is not a whole object."""
    out: dict[str, str] = {}
    depth, key, start, expect, end = 0, None, 0, "open", 0
    for m in _TOKEN.finditer(text):
        tok = m.group()
        if expect == "open":
            if tok != "{":
                return None
            depth, expect = 1, "key"
        elif depth == 0:
            return None
        elif depth == 1 and expect == "key" and tok[0] == '"':
            key, expect = json.loads(tok), "colon"
        elif depth == 1 and expect == "colon" and tok == ":":
            start, expect = -1, "value"
        else:
            if expect == "value" and start < 0:
                start = m.start()
            if tok in "{[":
                depth += 1
            elif tok in "}]":
                depth -= 1
            if depth == 0 or depth == 1 and tok == ",":
                if expect == "value" and start >= 0:
                    out[key] = text[start:end]
                key, expect, start = None, "key", -1
        end = m.end()
    return out if depth == 0 and expect == "key" else None


class _Node:
    __slots__ = ("address", "parent", "parts", "kids", "own", "skipped", "key", "at")

    def __init__(self, address: list[int], parent: int, n_flags: int):
        self.address, self.parent, self.parts, self.kids = address, parent, [], 0
        self.own, self.skipped, self.key, self.at = [False] * n_flags, False, None, 0


def call_tree(text: str, child_field: str = "calls", flags: tuple[str, ...] = (), skip_field: str | None = None):
    """Rows of a nested tree in depth-first order:
    (address, number of children, position or None, node text without its children, flag values).

    A flag is true when its field holds a value other than null on the node or an ancestor.
    Nodes with `skip_field` are returned without a position; they count neither as children
    nor for positions, and pass no flag on.
    """
    nodes: list[_Node] = []
    stack: list = []  # a node's number; ("kids", number, next position); or "other" inside plain values

    def open_node(address: list[int], parent: int) -> None:
        nodes.append(_Node(address, parent, len(flags)))
        stack.append(len(nodes) - 1)

    def leaf(address: list[int], parent: int, raw: str) -> None:
        nodes.append(_Node(address, parent, len(flags)))
        nodes[-1].parts = None
        nodes[-1].key = raw

    def value_done(n: _Node, end: int, null: bool) -> None:
        n.parts.append(text[n.at:end])
        if n.key in flags and not null:
            n.own[flags.index(n.key)] = True
        n.key = None

    started = False
    for m in _TOKEN.finditer(text):
        tok = m.group()
        if not stack:
            if started:
                break
            started = True
            if tok == "{":
                open_node([], -1)
                continue
            leaf([], -1, text.strip())
            break
        top = stack[-1]
        if top == "other":
            if tok in "{[":
                stack.append("other")
            elif tok in "}]":
                stack.pop()
                if isinstance(stack[-1], int):
                    value_done(nodes[stack[-1]], m.end(), False)
                elif isinstance(stack[-1], list) and stack[-1][3] is not None:
                    _, number, i, at = stack[-1]
                    leaf(nodes[number].address + [i], number, text[at:m.end()])
                    stack[-1][3] = None
        elif isinstance(top, int):
            n = nodes[top]
            if tok == "}":
                stack.pop()
            elif n.key is None:
                if tok != ",":
                    n.key, n.at = json.loads(tok), m.start()
                    if n.key == skip_field:
                        n.skipped = True
            elif tok != ":":
                if tok == "[" and n.key == child_field:
                    stack.append(["kids", top, 0, None])
                    n.key = None
                elif tok in "{[":
                    stack.append("other")
                elif n.key == child_field:  # a null in place of the children
                    n.key = None
                else:
                    value_done(n, m.end(), tok == "null")
        else:
            _, number, i, _ = top
            if tok == "]":
                stack.pop()
            elif tok == ",":
                top[2] += 1
            elif tok == "{":
                open_node(nodes[number].address + [i], number)
            elif tok == "[":
                top[3] = m.start()
                stack.append("other")
            else:
                leaf(nodes[number].address + [i], number, tok)
    rows, position = [], 0
    for n in nodes:
        if n.parent >= 0:
            up = nodes[n.parent]
            if not n.skipped:
                up.kids += 1
                n.own = [a or b for a, b in zip(n.own, up.own)]
            else:
                n.own = list(up.own)
        elif n.skipped:
            n.own = [False] * len(flags)
    for n in nodes:
        raw = n.key if n.parts is None else "{" + ",".join(n.parts) + "}"
        rows.append((n.address, n.kids, None if n.skipped else position, raw, n.own))
        position += not n.skipped
    return rows
