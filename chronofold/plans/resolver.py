"""Configuration values written as URLs: protocol://protocol://argument?key=value.

Protocols are applied from the inside out. ``take`` picks nested entries, ``json`` parses text, ``format`` fills in
keywords, ``file`` reads text, JSON, CSV or npy files, and further ones register themselves. Nothing is ever unpickled or executed.
"""

from __future__ import annotations

import ast
import csv
import functools
import io
import json
import re
from collections.abc import Callable
from urllib.parse import parse_qsl

PROTOCOLS: dict[str, Callable] = {}
PREPROCESSORS: list[tuple[int, Callable[[str], str]]] = []


def protocol(name: str):
    """Decorator: registers a function (argument, **options) for a protocol."""
    def add(f):
        PROTOCOLS[name] = f
        return f

    return add


def preprocessor(precedence: int = 0):
    """Decorator: a function on the raw text, lowest precedence first."""
    def add(f):
        PREPROCESSORS.append((precedence, f))
        PREPROCESSORS.sort(key=lambda x: x[0])
        return f

    return add


def _literal(text: str):
    try:
        return ast.literal_eval(text)
    except (ValueError, SyntaxError):
        return text


def split_query(url: str) -> tuple[str, dict]:
    """The part before the last ``?`` and its options; repeated options become lists, values Python literals."""
    head, found, tail = url.rpartition("?")
    if not found or "=" not in tail:
        return url, {}
    options: dict = {}
    for k, v in parse_qsl(tail, keep_blank_values=True):
        v = _literal(v)
        options[k] = [*(options[k] if isinstance(options[k], list) else [options[k]]), v] if k in options else v
    return head, options


def resolve(value, **context):
    """The value of a URL text; anything that is no URL is returned as it is."""
    if not isinstance(value, str) or "://" not in value:
        return value
    for _, f in PREPROCESSORS:
        value = f(value)
    return _cached(value, tuple(sorted((k, v) for k, v in context.items() if isinstance(v, (str, int, float))))) if context else _evaluate(value, {})


@functools.lru_cache(maxsize=256)
def _cached(value: str, context: tuple):
    return _evaluate(value, dict(context))


def _evaluate(value: str, context: dict):
    head, options = split_query(value)
    names = []
    while (m := re.match(r"([\w-]+)://", head)) and m[1] in PROTOCOLS:
        names.append(m[1])
        head = head[m.end() :]
    if not names:
        raise ValueError(f"no such protocol: {value.split('://')[0]}")
    out = _literal(head) if names[-1] not in ("json", "format", "file") else head
    for name in reversed(names):
        f = PROTOCOLS[name]
        wanted = f.__code__.co_varnames[1 : f.__code__.co_argcount + f.__code__.co_kwonlyargcount]
        given = {**context, **options}
        takes_all = bool(f.__code__.co_flags & 8)
        out = f(out, **(given if takes_all else {k: v for k, v in given.items() if k in wanted}))
    return out


@protocol("json")
def read_json(text):
    return json.loads(text)


@protocol("take")
def take(obj, take=()):
    for key in take if isinstance(take, list) else [take] if take != () else []:
        obj = obj[key]
    return obj


@protocol("format")
def fill_in(text, **options):
    return text.format(**options)


@protocol("file")
def read_file(path, fmt=None):
    kind = fmt or path.rsplit(".", 1)[-1]
    if kind == "npy":
        import numpy

        return numpy.load(path, allow_pickle=False)
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if kind == "json":
        return json.loads(text)
    return list(csv.DictReader(io.StringIO(text))) if kind == "csv" else text


@protocol("rekey_dict")
def rekey(obj, replace_keys="", with_keys=""):
    names = dict(zip(str(replace_keys).split(","), str(with_keys).split(",")))
    return {names.get(k, k): v for k, v in obj.items()}


@protocol("objects-to-dict")
def objects_to_dict(rows, key_attr=None, value_attr="value"):
    get = lambda r, a: r[a] if isinstance(r, dict) else getattr(r, a)
    return {get(r, key_attr): get(r, value_attr) for r in rows}


@protocol("list-to-array")
def list_to_array(rows):
    import numpy

    return numpy.asarray(rows)


@protocol("pad-array")
def pad_array(values, pad_left=0, pad_right=0, pad_value=0):
    return [pad_value] * pad_left + list(values) + [pad_value] * pad_right


@protocol("itp_dict")
def interpolated(rows, time=None, itp_keys="", time_key="time"):
    """Values at a time, linear between the rows around it; outside their range it raises."""
    rows = sorted(rows, key=lambda r: float(r[time_key]))
    at = [float(r[time_key]) for r in rows]
    if time is None or not at[0] <= float(time) <= at[-1]:
        raise ValueError("the time is outside the range of the values")
    i = max(k for k, t in enumerate(at) if t <= float(time))
    j = min(i + 1, len(at) - 1)
    part = 0.0 if i == j else (float(time) - at[i]) / (at[j] - at[i])
    keys = str(itp_keys).split(",")
    out = {k: float(rows[i][k]) + part * (float(rows[j][k]) - float(rows[i][k])) for k in keys}
    return out if len(keys) > 1 else out[keys[0]]


@protocol("run_doc")
def run_document(path, run_doc=None, default=None):
    """A dotted path with list indices in a run document."""
    obj = run_doc
    for part in str(path).split("."):
        try:
            obj = obj[int(part)] if isinstance(obj, list) else obj[part]
        except (KeyError, IndexError, TypeError, ValueError):
            return default
    return obj
