"""Run a preparation job: ``python -m prepkit TASK config.json`` or ``python -m prepkit TASK --flag value``."""

from __future__ import annotations

import sys

from prepkit.config import TASKS, parse_job
from prepkit.plans.jobs import run_job
from prepkit.session import get_session


def main(argv: list[str]) -> None:
    if not argv or argv[0] not in TASKS:
        raise SystemExit(f"usage: python -m prepkit {{{','.join(TASKS)}}} (config.json | --flag value ...)")
    job = parse_job(TASKS[argv[0]], argv[1:])
    report = run_job(get_session(), job)
    report.show(truncate=False)


if __name__ == "__main__":
    main(sys.argv[1:])
