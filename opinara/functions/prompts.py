"""Prompt texts for a user-supplied text model, rendered as column expressions.

Templates are the user's. {slots} are filled with columns; no text is built in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _render(template: str, **slots: Column) -> Column:
    """Fill {slot} marks of a template with columns."""
    out, rest = [], template
    while rest:
        found = [(rest.find("{" + s + "}"), s) for s in slots if "{" + s + "}" in rest]
        if not found:
            out.append(F.lit(rest))
            break
        at, slot = min(found)
        if at:
            out.append(F.lit(rest[:at]))
        out.append(F.coalesce(slots[slot].cast("string"), F.lit("")))
        rest = rest[at + len(slot) + 2 :]
    return F.concat(*out)


def request_prompt(template: str, **fixed: str) -> Callable[[Column, Column, Column], Column]:
    """Renders a request for texts: {n}, {label} and {exemplars} by class, other slots from `fixed`."""
    return lambda n, label, exemplars: _render(
        template, n=n, label=label, exemplars=exemplars, **{k: F.lit(v) for k, v in fixed.items()}
    )


def label_prompt(template: str, examples: Sequence[tuple[str, str]] = ()) -> Callable[[Column], Column]:
    """Renders a request for the label of {text}; {examples} holds the given (text, label) pairs, one a line."""
    shown = "\n".join(f"{text} => {label}" for text, label in examples)
    return lambda text: _render(template, text=text, examples=F.lit(shown))
