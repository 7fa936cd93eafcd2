"""python -m graphloom VERB --case-name NAME --root FOLDER ..: a verb of plans.verbs, whose parameters are its flags.

What is not given comes from the environment, see plans.settings. --service module:function names the service of a verb that uses one.
"""

from __future__ import annotations

import argparse
import inspect
import sys

from pyspark.sql import SparkSession

from graphloom.plans import settings
from graphloom.plans.verbs import VERBS

#: Parameters of verbs that are services, or make them.
SERVICES = frozenset(("make", "service"))
KINDS = {"int": int, "int | None": int, "float": float, "str": str}


def parser() -> argparse.ArgumentParser:
    """A sub-command for each verb: numbers and texts as options, resume as --no-resume, other switches by name."""
    top = argparse.ArgumentParser(prog="graphloom")
    verbs = top.add_subparsers(dest="verb", required=True)
    for name, call in VERBS.items():
        one = verbs.add_parser(name, help=inspect.getdoc(call))
        for flag in settings.NAMES:
            one.add_argument(f"--{flag.replace('_', '-')}", dest=flag)
        for p in list(inspect.signature(call).parameters.values())[2:]:
            flag = p.name.replace("_", "-")
            if p.annotation == "bool":
                one.add_argument(f"--no-{flag}" if p.default else f"--{flag}", dest=p.name, action="store_false" if p.default else "store_true")
            elif p.annotation in KINDS:
                one.add_argument(f"--{flag}", dest=p.name, type=KINDS[p.annotation], default=p.default)
            elif p.name in SERVICES:
                one.add_argument("--service", dest=p.name, default=settings.setting(f"{name}_service"), help="module:function")
    return top


def main(argv: list[str] | None = None) -> dict:
    given = vars(parser().parse_args(argv))
    name = given.pop("verb")
    case = settings.case({n: given.pop(n) for n in settings.NAMES})
    for n in SERVICES & given.keys():
        spec = given.pop(n)
        if spec:
            given[n] = settings.factory(spec)
        elif inspect.signature(VERBS[name]).parameters[n].default is inspect.Parameter.empty:
            raise ValueError(f"not given: --service or GRAPHLOOM_{name.upper()}_SERVICE")
    found = VERBS[name](SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate(), case, **given)
    print(found)
    return found


if __name__ == "__main__":
    main(sys.argv[1:])
