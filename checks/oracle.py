"""Builds one DuckDB statement from named CTEs, taking in only those that it uses."""

from __future__ import annotations

import re

from checks.fixtures import Duck, definitions, duck_ctes

_STEPS: dict[str, str] = {}
_NAME = re.compile(r"\b(fx_\w+|c_[a-z]\w*)\b")
u = Duck.u


def step(name: str, text: str) -> None:
    """Register CTE ``name`` (c_...); it may use fixtures (fx_...) and earlier steps.

    A step that starts with RECURSIVE is written as given after its name.
    """
    _STEPS[name] = text


def variant(name: str, tag: str, swaps: dict[str, str]) -> str:
    """Register copies of step ``name`` and of the steps below it that ``swaps`` of text touch.

    A copy is named c_<tag>_<name>; returns the name to read, the old one if nothing changes.
    """
    names: dict[str, str] = {}

    def copy(own: str) -> str:
        if own not in names:
            text = new = _STEPS[own]
            for old, to in swaps.items():
                new = new.replace(old, to)
            below = {n: copy(n) for n in dict.fromkeys(_NAME.findall(text)) if n in _STEPS and n != own}
            new = _NAME.sub(lambda found: below.get(found[0], found[0]), new)
            names[own] = own if new == text else f"c_{tag}_{own[2:]}"
            _STEPS.setdefault(names[own], new)
        return names[own]

    return copy(name)


def statement(final: str) -> str:
    steps: list[str] = []
    fixtures: set[str] = set()

    def visit(text: str, own: str = "") -> None:
        for name in _NAME.findall(text):
            if name == own:
                continue
            if name.startswith("fx_"):
                if name[3:] in definitions(Duck):
                    fixtures.add(name[3:])
            elif name in _STEPS and name not in steps:
                visit(_STEPS[name], name)
                if name not in steps:
                    steps.append(name)

    visit(final)
    parts = duck_ctes(sorted(fixtures))
    recursive = False
    for name in steps:
        text = _STEPS[name]
        if text.startswith("RECURSIVE "):
            recursive = True
            parts.append(text.removeprefix("RECURSIVE "))
        else:
            parts.append(f"{name} AS MATERIALIZED ({text})")
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {final}"
