"""Command line: ``python -m pathgauge STEP... --inputs DIR --output DIR [--config FILE] [--profile NAME]``."""

from __future__ import annotations

import argparse
import sys

from pathgauge.params import PROFILES, Params, from_config, profile
from pathgauge.session import session
from pathgauge.sources import tables
from pathgauge.workflow import Run, read_inputs

STEPS = ("prepare", "score", "trajectory", "intensity", "assemble")


def _params(config: str | None, name: str) -> Params:
    if config is None:
        return profile(name)
    import yaml  # only needed when a configuration file is given

    with open(config, encoding="utf-8") as file:
        return from_config(yaml.safe_load(file), name)


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="pathgauge", description=__doc__)
    parser.add_argument("steps", nargs="*", choices=[*STEPS, []], help="steps to run, default all")
    parser.add_argument("--inputs", required=True, help="folder of input CSV files")
    parser.add_argument("--output", required=True, help="folder for stage and result tables")
    parser.add_argument("--config", help="YAML file with a default section and profiles")
    parser.add_argument("--profile", default="default", help=f"profile name, built in: {', '.join(PROFILES)}")
    parser.add_argument("--template", help="report workbook that lists the companies, in place of roster.csv in the inputs")
    parser.add_argument("--master", help="Spark master; taken from spark-submit when left out")
    options = parser.parse_args(arguments)

    params = _params(options.config, options.profile)
    spark = session("pathgauge", options.master)
    run = Run(spark, options.output, options.profile, params)
    for step in options.steps or STEPS:
        if step == "prepare":
            inputs = read_inputs(spark, options.inputs, params, options.output)
            if inputs.reject_counts:
                print(f"cells of the production file that could not be read, by column: {inputs.reject_counts}", file=sys.stderr)
            run.prepare(inputs)
        elif step == "assemble":
            if options.template:
                run.assemble(template=options.template)
            else:
                run.assemble(tables.read_text(spark, f"{options.inputs}/roster.csv"))
        else:
            getattr(run, step)()
    return 0


if __name__ == "__main__":
    sys.exit(main())
