"""python -m linkforge JOB --option value ...: the jobs of linkforge.jobs, by the names of their parameters."""

from __future__ import annotations

import argparse
import inspect
import json
import sys

from pyspark.sql import SparkSession

from . import jobs
from .operators.features import load_model
from .operators.matching import POLICIES, Matching
from .sources.sinks import read_text

JOBS = {f.__name__.replace("_", "-"): f for f in (jobs.generate, jobs.write_outputs, jobs.write_scored_outputs, jobs.train, jobs.thresholds, jobs.score, jobs.coverage, jobs.describe)}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="linkforge", description=__doc__)
    commands = out.add_subparsers(dest="job", required=True)
    for name, job in JOBS.items():
        command = commands.add_parser(name, description=inspect.getdoc(job))
        for p in list(inspect.signature(job).parameters.values())[1:]:
            option, needed = "--" + p.name.replace("_", "-"), p.default is p.empty
            if p.name == "config":
                command.add_argument("--policy", choices=POLICIES, default="empty")
                command.add_argument("--threshold", type=float, default=0.90)
                command.add_argument("--max-matches", type=int)
            elif p.name == "model":
                command.add_argument("--model-json")
            elif isinstance(p.default, bool):
                command.add_argument(option, action="store_true")
            else:
                kind = next((t for t, names in ((int, ("int",)), (float, ("float",))) if str(p.annotation).split(" |")[0] in names), str)
                command.add_argument(option, type=kind, required=needed, default=None if needed else p.default)
    return out


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> object:
    given = vars(parser().parse_args(arguments))
    spark = spark or SparkSession.builder.appName("linkforge").getOrCreate()
    job = JOBS[given.pop("job")]
    if "policy" in given:
        given["config"] = Matching(given.pop("threshold"), given.pop("max_matches"), given.pop("policy"))
    if (path := given.pop("model_json", None)) is not None:
        given["model"] = load_model(read_text(spark, path))
    result = job(spark, **given)
    print(result if isinstance(result, str) else json.dumps(result, indent=2, sort_keys=True, default=str))
    return result


if __name__ == "__main__":
    main()
    sys.exit(0)
