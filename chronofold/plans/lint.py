"""Checks of configuration URLs: patterns that pick the URLs, and functions that say what is wrong with them."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping

from chronofold.plans.resolver import split_query

CHECKS: list[tuple[re.Pattern, Callable[[str, dict], Iterator[str]]]] = []


def check(pattern: str):
    """Decorator: a function (url, options) that yields messages, for every URL in which the pattern is found."""
    def add(f):
        CHECKS.append((re.compile(pattern), f))
        return f

    return add


def lint(url: str) -> list[str]:
    """All messages about a URL; none for a value that is no URL."""
    if not isinstance(url, str) or "://" not in url:
        return []
    _, options = split_query(url)
    return [m for pattern, f in CHECKS if pattern.search(url) for m in f(url, options)]


def lint_config(config: Mapping[str, object]) -> dict[str, list[str]]:
    return {k: found for k, v in config.items() if isinstance(v, str) and (found := lint(v))}


@check(r"^cmt://|://cmt://")
def removed(url, options):
    yield "the protocol is removed"


@check(r"corrections://")
def versioned(url, options):
    if "version" not in options:
        yield "a correction needs a version"
    if "attr" not in options:
        yield "without attr the whole document is returned"
    if "list-to-array" in url or "objects-to-dict" in url:
        if not options.get("as_list"):
            yield "lists need as_list=True"
        if "sort" not in options:
            yield "lists need a sort argument"


@check(r"corrections://[^?]*_maps?\b")
def maps(url, options):
    if options.get("attr") != "map" and "tf://" not in url:
        if "itp_map://" not in url:
            yield "a map needs itp_map://"
        if "resource://" not in url:
            yield "a map's file needs resource://"


@check(r"posrec_models")
def models(url, options):
    if "tf://" not in url and "jax://" not in url:
        yield "a position model needs tf:// or jax://"


@check(r"objects-to-dict")
def keyed(url, options):
    for name in ("key_attr", "value_attr"):
        if name not in options:
            yield f"a dictionary needs {name}"
