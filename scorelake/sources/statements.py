"""Running SQL: one statement, a script, many statements at once."""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ..functions.conf import with_conf as with_conf

#: Statements run at the same time unless told otherwise.
MAX_CONCURRENT = 4
# Quoted text and comments are one piece each, so a ";" inside does not count.
_PIECE = re.compile(r"""'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*"|`[^`]*`|--[^\n]*|/\*.*?\*/|;|.""", re.DOTALL)


def split_statements(script: str) -> list[str]:
    """Statements of a script cut at ``;``, without empty ones. Quotes and comments are respected."""
    statements, current = [], ""
    for piece in _PIECE.findall(script):
        if piece == ";":
            statements.append(current)
            current = ""
        else:
            current += piece
    bare = re.compile(r"--[^\n]*|/\*.*?\*/", re.DOTALL)
    return [s.strip() for s in [*statements, current] if bare.sub("", s).strip()]


def session_with(spark: SparkSession, conf: dict | None) -> SparkSession:
    """A session of its own with options set; shares tables, but not temporary views."""
    if not conf:
        return spark
    session = spark.newSession()
    for key, value in conf.items():
        session.conf.set(key, value)
    return session


def run_sql(
    spark: SparkSession,
    sql: str,
    args: dict | list | None = None,
    database: str | None = None,
    n_rows: int | None = None,
    conf: dict | None = None,
) -> DataFrame:
    """Run one statement; the result is lazy, commands take effect at once.

    Parameters are bound by the engine, never pasted into the text. `n_rows`
    limits the result: None or negative means all rows, 0 none.
    """
    session = session_with(spark, conf)
    previous = session.catalog.currentDatabase()
    if database:
        session.catalog.setCurrentDatabase(database)
    try:
        result = session.sql(sql.strip().rstrip(";"), args=args)
    finally:
        if database:
            session.catalog.setCurrentDatabase(previous)
    return result if n_rows is None or n_rows < 0 else result.limit(n_rows)


def run_sqls(
    spark: SparkSession,
    sqls: str | list[str],
    args: dict | list | None = None,
    conf: dict | list | None = None,
    database: str | None = None,
    n_jobs: int = MAX_CONCURRENT,
    sync: bool = True,
    action: Callable[[DataFrame], object] | None = None,
) -> list:
    """Run statements side by side; results keep the order of the statements.

    A failing statement leaves its exception in its slot. `args` and `conf` are
    shared when a dict, or one per statement when a list. Results are lazy
    frames; `action`, such as a write or a count, is applied inside the thread,
    which is what makes their jobs overlap. With a database or options,
    statements run in sessions that see tables but no temporary views. With ``sync=False`` the futures are
    returned at once. Each call has its own scheduler pool, so under
    ``spark.scheduler.mode=FAIR`` calls share the cluster evenly.
    """
    statements = split_statements(sqls) if isinstance(sqls, str) else list(sqls)
    pool = f"run_sqls-{uuid4().hex[:8]}"

    def run(i: int):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
        mine = args[i] if isinstance(args, list) else args
        options = conf[i] if isinstance(conf, list) else conf
        # The current database belongs to a session, so threads must not share one.
        session = spark.newSession() if database else spark
        result = run_sql(session, statements[i], mine, database, conf=options)
        return action(result) if action else result

    return run_all([lambda i=i: run(i) for i in range(len(statements))], n_jobs, sync, spark)


def run_all(tasks: list[Callable], n_jobs: int, sync: bool, spark: SparkSession) -> list:
    """Run driver-side tasks in threads; results or exceptions in order, or futures."""
    executor = ThreadPoolExecutor(max_workers=max(1, n_jobs))
    futures: list[Future] = [executor.submit(inheritable_thread_target(spark)(task)) for task in tasks]
    executor.shutdown(wait=False)
    if not sync:
        return futures
    return [f.exception() or f.result() for f in futures]


def run_sql_script(
    spark: SparkSession,
    script: str,
    concurrent: bool = False,
    args: dict | list | None = None,
    conf: dict | list | None = None,
    sync: bool = True,
    n_jobs: int = MAX_CONCURRENT,
) -> list:
    """Run the statements of a script, in order or side by side.

    In order, a statement that fails ends the script: its exception is the last
    result. Statements are commands or lazy queries, so a query fails here only
    if it can't be analysed. Side by side, every statement is run.
    """
    if concurrent:
        return run_sqls(spark, script, args, conf, n_jobs=n_jobs, sync=sync)

    def in_order() -> list:
        results = []
        for i, statement in enumerate(split_statements(script)):
            mine = args[i] if isinstance(args, list) else args
            options = conf[i] if isinstance(conf, list) else conf
            try:
                results.append(run_sql(spark, statement, mine, conf=options))
            except Exception as error:  # noqa: BLE001
                results.append(error)
                break
        return results

    return in_order() if sync else run_all([in_order], 1, False, spark)


def run_sql_file(spark: SparkSession, path: str, encoding: str = "utf-8", concurrent: bool = False, **options) -> list:
    """Run a file of statements that lies on the driver."""
    with open(path, encoding=encoding) as file:
        return run_sql_script(spark, file.read(), concurrent, **options)
