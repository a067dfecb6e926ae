"""Command line for the batch jobs.

    spark-submit ... lexiloom/__main__.py all --data DATA/raw --out DATA/processed
    python -m lexiloom readability --out DATA/processed --windows 5 10 20

The session comes from the environment (spark-submit, spark-defaults), not from here.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from lexiloom import dimensions
from lexiloom.operators import diagnostics
from lexiloom.operators.readability import WINDOW_SIZES
from lexiloom.plans.jobs import Layout, forget, run_all, run_readability, run_stylometry
from lexiloom.sources.sinks import export_corpus
from lexiloom.sources.tables import read_documents, read_tokens
from lexiloom.sources.validation import storage_footprint, validate_corpus

#: Rows of a table on the screen; the whole table is stored.
SHOWN_ROWS = 300


def _show(title: str, df: DataFrame) -> None:
    print(title)
    df.show(SHOWN_ROWS, truncate=False)


def _keep(args: argparse.Namespace, name: str, title: str, df: DataFrame) -> None:
    """Store the whole table below ``--out`` and show its first rows."""
    path = f"{args.out}/{name}"
    df.write.mode("overwrite").parquet(path)
    _show(f"{title} ({path})", df)


def _all(spark: SparkSession, args: argparse.Namespace) -> None:
    overview = run_all(spark, args.data, args.out, window_sizes=args.windows, resume=args.resume)
    for title, df in overview.items():
        _show(title, df)


def _validate(spark: SparkSession, args: argparse.Namespace) -> None:
    manifest = dimensions.manifest_dim(spark)
    verdicts = validate_corpus(manifest, args.data)
    _keep(args, "file_verdicts", "files", verdicts.orderBy("status", "author", "document_id"))


def _export(spark: SparkSession, args: argparse.Namespace) -> None:
    corpus = read_documents(spark, Layout(args.out).corpus_parquet)
    for fmt in ("csv", "json"):
        export_corpus(corpus, f"{args.out}/corpus_{fmt}", fmt)


def _readability(spark: SparkSession, args: argparse.Namespace) -> None:
    out = Layout(args.out)
    forget(spark, args.out, "readability")
    run_readability(
        spark, out.tokens, out.readability_global, out.readability_sliding, args.windows
    )


def _stylometry(spark: SparkSession, args: argparse.Namespace) -> None:
    out = Layout(args.out)
    forget(spark, args.out, "stylometry")
    run_stylometry(spark, out.tokens, out.zipf, out.dialog, out.ttr, out.pos)


def _diagnose(spark: SparkSession, args: argparse.Namespace) -> None:
    tokens = diagnostics.verify_tokens(read_tokens(spark, Layout(args.out).tokens))
    tokens.printSchema()
    by_author, counts = diagnostics.tokens_by_author(tokens), diagnostics.quote_counts(tokens)
    _keep(args, "tokens_by_author", "tokens by author", by_author)
    _keep(args, "quote_counts", "quote and dash tokens", counts)
    by_document = diagnostics.quote_counts_by_document(tokens)
    _keep(args, "quote_counts_by_document", "quote and dash tokens by document", by_document)
    _keep(args, "quote_samples", "in text order", diagnostics.quote_samples(tokens))


def _footprint(spark: SparkSession, args: argparse.Namespace) -> None:
    out = Layout(args.out)
    folders = [path for name, path in vars(out).items() if name != "root"]
    folders += [f"{args.out}/corpus_csv", f"{args.out}/corpus_json"]
    _show("sizes", storage_footprint(spark, [(path.rsplit("/", 1)[-1], path) for path in folders]))


COMMANDS = {
    "all": _all,
    "validate": _validate,
    "export": _export,
    "readability": _readability,
    "stylometry": _stylometry,
    "diagnose": _diagnose,
    "footprint": _footprint,
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lexiloom", description=__doc__.split("\n")[0])
    parser.add_argument("command", choices=sorted(COMMANDS))
    parser.add_argument("--data", default="DATA/raw", help="corpus directory")
    parser.add_argument("--out", default="DATA/processed", help="folder of the stored tables")
    parser.add_argument("--windows", type=int, nargs="+", default=list(WINDOW_SIZES))
    parser.add_argument("--resume", action="store_true", help="leave out finished stages (all)")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"lexiloom-{args.command}").getOrCreate()
    COMMANDS[args.command](spark, args)


if __name__ == "__main__":
    main()
