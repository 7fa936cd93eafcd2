"""Settings of a case from the environment: GRAPHLOOM_ and a name in capitals. What is given to a command wins."""

from __future__ import annotations

import importlib
import os
from collections.abc import Callable

from graphloom.plans.verbs import Case

NAMES = ("case_name", "root", "tenant", "project", "input")


def setting(name: str, default: str = "") -> str:
    return os.environ.get(f"GRAPHLOOM_{name.upper()}", "") or default


def case(given: dict[str, str | None]) -> Case:
    """A case of given values, then of the environment's: CASE_NAME, ROOT, TENANT, PROJECT (or PROJECT_UUID), INPUT. ValueError names what is missing.
    An input folder that is not absolute and has no scheme stands below the root."""
    found = {n: given.get(n) or setting(n) for n in NAMES}
    missing = [n for n in ("case_name", "root") if not found[n]]
    if missing:
        raise ValueError(f"not given: {', '.join(f'--{n.replace("_", "-")} or GRAPHLOOM_{n.upper()}' for n in missing)}")
    root = found["root"].rstrip("/")
    if found["input"] and not found["input"].startswith("/") and "://" not in found["input"]:
        found["input"] = f"{root}/{found['input']}"
    place = {n: found[n] for n in ("tenant", "project", "input") if found[n]}
    return Case(found["case_name"], root, **place)


def factory(name: str) -> Callable:
    """What module:attribute names: a function that makes a service, or is one."""
    module, _, attribute = name.partition(":")
    if not attribute:
        raise ValueError(f"a service is named module:function, not {name!r}")
    return getattr(importlib.import_module(module), attribute)
