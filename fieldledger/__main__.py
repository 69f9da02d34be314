"""Command line: `spark-submit fieldledger/__main__.py build|describe|chat ...`."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fieldledger import fixed_values as fv  # noqa: E402
from fieldledger.functions.chat import CONVERSATION_CHAT, RECORD_CHAT  # noqa: E402
from fieldledger.functions.report import ReportTemplate  # noqa: E402
from fieldledger.plans.chat_texts import compare_responses, prepare_chat_texts, prepare_conversations  # noqa: E402
from fieldledger.plans.dataset import DatasetConfig, build_dataset  # noqa: E402
from fieldledger.plans.describe import describe_dataset  # noqa: E402
from fieldledger.sources.readers import year_globs  # noqa: E402


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="fieldledger")
    jobs = parser.add_subparsers(dest="job", required=True)

    build = jobs.add_parser("build", help="incidents and activity log to JSON lines")
    build.add_argument("--incidents", required=True)
    build.add_argument("--log", required=True, help="folder of <year>*.csv files")
    build.add_argument("--output", required=True)
    build.add_argument("--years", type=int, nargs="+", default=list(fv.ACTIVITY_YEARS))
    build.add_argument("--log-width", type=int, default=fv.ACTIVITY_WIDTH)
    build.add_argument("--max-records", type=int, default=0, help="bound of the incidents; 0 keeps all")
    build.add_argument("--spread", type=int, help="tasks that incidents of few files are dealt out to")
    build.add_argument("--columns", help="JSON file that maps source columns to fields")
    build.add_argument("--files-per-split", type=int)
    build.add_argument("--multiline", action="store_true")
    build.add_argument("--random", action="store_true", help="random split instead of hash split")
    build.add_argument("--wording", help="JSON file with the fields of ReportTemplate")
    build.add_argument("--names", help="JSON file that maps codes to country names")

    describe = jobs.add_parser("describe", help="profile of the written splits")
    describe.add_argument("--input", required=True)
    describe.add_argument("--output", required=True)

    chat = jobs.add_parser("chat", help="chat texts of one split")
    chat.add_argument("--input", required=True)
    chat.add_argument("--output", required=True)
    chat.add_argument("--split", default="train")
    chat.add_argument("--system", default=ReportTemplate().system)
    chat.add_argument("--markers", help="JSON file with the fields of ChatTemplate")

    talks = jobs.add_parser("conversations", help="chat texts, messages, pairs and prompts of conversations")
    talks.add_argument("--input", required=True)
    talks.add_argument("--output", required=True)
    talks.add_argument("--markers", help="JSON file with the fields of ChatTemplate")
    talks.add_argument("--prompt", action="store_true", help="end each text with the opening of an answer")
    talks.add_argument("--history-turns", type=int, default=0, help="most messages before a prompt; 0: all")
    talks.add_argument("--history-chars", type=int, default=0, help="most characters before a prompt; 0: all")

    sift = jobs.add_parser("sift", help="records of JSON lines, and the lines that are none")
    sift.add_argument("--input", required=True)
    sift.add_argument("--output", required=True)

    versus = jobs.add_parser("compare", help="two sets of responses to the same prompts")
    versus.add_argument("--base", required=True)
    versus.add_argument("--tuned", required=True)
    versus.add_argument("--output", required=True)
    return parser


def told(path: str | None, otherwise: dict) -> dict:
    """The JSON object in the file, or the other one without a file."""
    return json.loads(Path(path).read_text("utf-8")) if path else otherwise


def main() -> None:
    given = arguments().parse_args()
    spark = (
        SparkSession.builder.appName(f"fieldledger-{given.job}")
        # A task writes its splits side by side instead of sorting its rows by split.
        .config("spark.sql.maxConcurrentOutputFileWriters", len(fv.SPLIT_FRACTIONS))
        .getOrCreate()
    )
    if given.job == "build":
        wording = told(given.wording, {})
        names = told(given.names, fv.COUNTRY_NAMES)
        report = build_dataset(
            spark,
            DatasetConfig(
                incidents_path=given.incidents,
                log_paths=year_globs(given.log, given.years),
                output_path=given.output,
                names=names,
                columns=told(given.columns, fv.INCIDENT_COLUMNS),
                spread=given.spread,
                years=given.years,
                log_width=given.log_width,
                max_records=given.max_records,
                files_per_split=given.files_per_split,
                multiline=given.multiline,
                random=given.random,
                template=ReportTemplate(**wording),
            ),
        )
        tables = vars(report)
    elif given.job == "describe":
        tables = describe_dataset(spark, given.input, given.output)
    elif given.job == "chat":
        markers = replace(RECORD_CHAT, **told(given.markers, {}))
        tables = prepare_chat_texts(spark, given.input, given.output, given.split, markers, given.system)
    elif given.job == "conversations":
        markers = replace(CONVERSATION_CHAT, **told(given.markers, {}))
        tables = prepare_conversations(spark, given.input, given.output, markers, given.prompt, given.history_turns, given.history_chars)
    elif given.job == "sift":
        tables = sift_records(spark, given.input, given.output)
    else:
        tables = compare_responses(spark, given.base, given.tuned, given.output)
    for name, table in tables.items():
        print(name)
        table.show(100, truncate=False)


if __name__ == "__main__":
    main()
