"""SQL building blocks for operators that use DataFrame functions only.

All return SQL text.  A running state over an array is a fold that appends to its
result; appending copies, so a plain fold is quadratic.  ``scan`` folds chunks of
about the square root of the length instead, which copies little.
"""

from __future__ import annotations

import itertools

_names = itertools.count()


def _fresh(*stems: str) -> list[str]:
    """Lambda variables that no other block uses."""
    k = next(_names)
    return [f"{s}_{k}" for s in stems]


def bind(value: str, body) -> str:
    """``body`` of a variable that holds ``value``, computed once."""
    v, = _fresh("v")
    return f"transform(array({value}), {v} -> {body(v)})[0]"


def step_size(array: str) -> str:
    return f"cast(ceil(sqrt(size({array}))) as int)"


def chunks(array: str) -> str:
    """The array cut into parts of about the square root of its length."""
    def cut(v):
        k, = _fresh("k")
        return (f"if(size({v}) = 0, slice(array({v}), 1, 0), "
                f"transform(sequence(0, size({v}) - 1, {step_size(v)}), {k} -> slice({v}, {k} + 1, {step_size(v)})))")
    return bind(array, cut)


def scan(array: str, state: str, step, emit, out: str) -> str:
    """``emit(state, x)``, of SQL type ``out``, for every x of the array, where
    the state starts as ``state`` and becomes ``step(state, x)`` after each."""
    acc, part, a, x, z = _fresh("acc", "part", "a", "x", "z")
    inner = (f"aggregate({part}, named_struct('s', {acc}.s, 'o', cast(array() as array<{out}>)), "
             f"({a}, {x}) -> named_struct('s', {step(a + '.s', x)}, 'o', concat({a}.o, array({emit(a + '.s', x)}))))")
    return (f"aggregate({chunks(array)}, named_struct('s', {state}, 'o', cast(array() as array<array<{out}>>)), "
            f"({acc}, {part}) -> transform(array({inner}), {z} -> named_struct('s', {z}.s, 'o', concat({acc}.o, array({z}.o))))[0], "
            f"{acc} -> flatten({acc}.o))")


def located(text: str, pattern: str, size=lambda s: f"length({s})") -> str:
    """Array of (s, e, x): every match of a pattern in a text, leftmost and not
    overlapping, with the sizes of the text before it and up to its end.

    Splitting at the same pattern gives the pieces between the matches; only
    sizes are added up, so no part of the text is copied twice.
    """
    shape = "struct<s:int,e:int,x:string>"

    def places(m):
        x, i = _fresh("x", "i")

        def sized(p):
            return f"transform({m}, ({x}, {i}) -> named_struct('g', {size(f'{p}[{i}]')}, 'n', {size(x)}, 'x', {x}))"

        return (f"if(size({m}) = 0, cast(array() as array<{shape}>), "
                + scan(bind(f"split({text}, {pattern}, -1)", sized), "0",
                       lambda s, r: f"{s} + {r}.g + {r}.n",
                       lambda s, r: f"named_struct('s', {s} + {r}.g, 'e', {s} + {r}.g + {r}.n, 'x', {r}.x)", shape) + ")")
    return bind(f"regexp_extract_all({text}, {pattern}, 0)", places)
