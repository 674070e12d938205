"""Command line (CLI-*): migrate, refresh, ingest, reprocess, embed."""

from __future__ import annotations

import argparse
import logging
from datetime import date

from .config import load_settings


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ledgerloom")
    commands = top.add_subparsers(dest="command", required=True)
    db = commands.add_parser("db").add_subparsers(dest="action", required=True)
    db.add_parser("migrate")
    db.add_parser("refresh-analytics")
    vector = db.add_parser("enable-vector")
    vector.add_argument("--profile", default="default")
    vector.add_argument("--model")
    vector.add_argument("--dimensions", type=int)

    def bounds(p: argparse.ArgumentParser, *names: str) -> None:
        for end, name in zip(("from", "to"), names or ("--from-date", "--to-date"), strict=True):
            p.add_argument(name, type=date.fromisoformat, dest=f"{end}_date")

    def forms(p: argparse.ArgumentParser) -> None:
        p.add_argument("--form-type", default="all", choices=["all", "10-K", "10-Q"])

    ingest = commands.add_parser("ingest").add_subparsers(dest="family", required=True)
    for name in ("13f", "periodic"):
        p = ingest.add_parser(name)
        p.add_argument("--mode", choices=["dev", "full", "daily"], required=True)
        bounds(p)
        p.add_argument("--limit-filings", type=int)
        p.add_argument("--dry-run", action="store_true")
        p.add_argument("--mirror", help="a Parquet table of url and content to read documents from, in place of the archive")
        p.add_argument("--tasks", type=int, default=1, help="fetch in so many Spark tasks, which share the rate")
        if name == "13f":
            p.add_argument("--skip-analytics-refresh", action="store_true")
        else:
            forms(p)
            p.add_argument("--exclude-amendments", action="store_true")
    again = commands.add_parser("reprocess").add_subparsers(dest="family", required=True)
    for name in ("13f", "periodic"):
        p = again.add_parser(name)
        p.add_argument("--accession")
        bounds(p)
        if name == "13f":
            p.add_argument("--skip-analytics-refresh", action="store_true")
    backfill = commands.add_parser("embeddings").add_subparsers(dest="action", required=True).add_parser("backfill").add_subparsers(dest="family", required=True)
    p = backfill.add_parser("periodic")
    for option in ("--profile", "--cik", "--ticker", "--model"):
        p.add_argument(option)
    forms(p)
    bounds(p, "--filed-from", "--filed-to")
    p.add_argument("--limit", type=int)
    p.add_argument("--batch-size", type=int)
    p.add_argument("--rebuild", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    settings = load_settings()
    logging.basicConfig(level=settings.log_level, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    from .operators.embedding import Profile, Selection, embedder
    from .plans import acquire, backfill, ingest, refresh
    from .plans.fetch import Fetcher
    from .plans.store import Store
    from .session import session

    spark = session()
    store = Store(spark, settings.store)
    family = {"13f": ingest.HOLDINGS, "periodic": ingest.PERIODIC}.get(getattr(args, "family", ""), "")
    if args.command == "db":
        if args.action == "migrate":
            print("\n".join(store.migrate()))
        elif args.action == "refresh-analytics":
            print("\n".join(refresh.refresh_views(store)))
        else:
            profile = backfill.enable_vectors(store, Profile(args.profile, model=args.model or settings.embedding_model, embedding_dimension=args.dimensions or settings.embedding_dimension))
            print(f"{profile.profile_name}: {profile.model}, {profile.embedding_dimension} dimensions")
        return 0
    if args.command == "ingest":
        options = ingest.Options(
            family, args.mode, args.from_date, args.to_date, getattr(args, "form_type", "all"), not getattr(args, "exclude_amendments", False), args.limit_filings, args.dry_run, not getattr(args, "skip_analytics_refresh", True)
        )
        if not settings.user_agent and not args.mirror:
            raise SystemExit("LEDGERLOOM_USER_AGENT has to name who is asking")
        agent, rate, timeout = settings.user_agent, settings.requests_per_second, settings.http_timeout
        if args.mirror:
            fetcher = acquire.mirror(spark.read.parquet(args.mirror))
        elif args.tasks > 1:
            fetcher = acquire.fetching(lambda share: Fetcher(agent, per_second=share, timeout=timeout), rate, args.tasks)
        else:
            fetcher = Fetcher(agent, per_second=rate, timeout=timeout)
        return ingest.run_ingest(spark, store, fetcher, settings.artifacts, options, archive=settings.archive)
    if args.command == "reprocess":
        return int(ingest.run_reprocess(spark, store, settings.artifacts, family, args.accession, args.from_date, args.to_date, not getattr(args, "skip_analytics_refresh", False)).failed > 0)
    profile = Profile(args.profile or "default", model=args.model or settings.embedding_model, embedding_dimension=settings.embedding_dimension)
    chosen = Selection(args.cik, args.ticker, args.form_type, args.from_date, args.to_date, args.rebuild, args.limit)
    counts = backfill.run_backfill(store, profile, embedder(settings, profile), chosen, args.batch_size or settings.embedding_batch, settings.embeddings_enabled, args.dry_run)
    print(counts)
    return int(counts.get("failed", 0) > 0)


if __name__ == "__main__":
    raise SystemExit(main())
