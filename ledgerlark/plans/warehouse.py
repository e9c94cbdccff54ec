"""The warehouse DAG: feeds -> staging -> intermediate -> marts, built lazily.

``Warehouse`` wires the pure ``DataFrame -> DataFrame`` operators together.  Each
dataset is a cached property holding a *lazy* DataFrame, so asking for one mart
plans exactly the lineage it needs and Catalyst prunes every unused column back
to the parquet scan.  ``plans.pipeline.materialize`` writes the datasets with
several consumers and the marts and re-plans the others on the written tables; which
these are follows from the DAG itself (``written_datasets``).
"""

from __future__ import annotations

import ast
import inspect
import textwrap
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.config import WarehouseConfig
from ledgerlark.operators import intermediate as I
from ledgerlark.operators import marts as M
from ledgerlark.operators import staging as S
from ledgerlark.session import ensure_defaults
from ledgerlark.sources import seeds
from ledgerlark.sources.feeds import derive_feeds


class dataset(cached_property):
    """A node of the DAG.  ``projection``: row by row from another node, never worth writing;
    ``sized``: written by a run although it has one consumer, whose join is planned by its size."""

    projection = sized = False


def projection(fn):
    node = dataset(fn)
    node.projection = True
    return node


def sized(fn):
    node = dataset(fn)
    node.sized = True
    return node


class Warehouse:
    def __init__(self, spark: SparkSession, feeds: dict[str, DataFrame], config: WarehouseConfig | None = None):
        self.spark = ensure_defaults(spark)
        self.feeds = feeds
        self.config = config or WarehouseConfig()
        self.source_root: str | None = None

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, root: str, **kw) -> Warehouse:
        """Feeds derived from the driver parquet tables (FIXTURES.md §2)."""
        wh = cls(spark, derive_feeds(spark, root), **kw)
        wh.source_root = root
        return wh

    def forget_plans(self) -> None:
        """Drop the plans built so far; the next access plans on what is written by then."""
        for name, member in vars(type(self)).items():
            if isinstance(member, cached_property):
                self.__dict__.pop(name, None)

    # seeds ---------------------------------------------------------------
    @cached_property
    def intent_catalog(self) -> DataFrame:
        return seeds.intent_catalog(self.spark)

    @cached_property
    def model_catalog(self) -> DataFrame:
        return seeds.model_catalog(self.spark)

    @cached_property
    def model_aliases(self) -> DataFrame:
        return seeds.model_aliases(self.spark)

    # staging -------------------------------------------------------------
    @dataset
    def stg_users(self) -> DataFrame:
        return S.stg_users(self.feeds["users"])

    @dataset
    def stg_conversations(self) -> DataFrame:
        return S.stg_conversations(self.feeds["conversations"])

    @sized
    def typed_requests(self) -> DataFrame:
        """The request rows, typed, replays included: the feed is derived once, every later step reads these."""
        return S.typed_requests(self.feeds["llm_requests"])

    @sized
    def request_replays(self) -> DataFrame:
        """Hashes of the request_ids that came more than once."""
        return S.replayed_requests(self.typed_requests)

    @property
    def request_rows(self) -> DataFrame:
        """The rows that ``request_replays`` was found in: in a run they are written before it, so who waits for it has both."""
        return self.typed_requests

    @dataset
    def stg_llm_requests(self) -> DataFrame:
        return S.stage_typed_requests(self.request_rows, self.model_aliases, self.request_replays)

    @dataset
    def stg_intent_predictions(self) -> DataFrame:
        return S.stg_intent_predictions(self.feeds["intent_predictions"])

    @dataset
    def stg_escalations(self) -> DataFrame:
        return S.stg_escalations(self.feeds["escalations"])

    @dataset
    def stg_daily_model_prices(self) -> DataFrame:
        return S.stg_daily_model_prices(self.feeds["daily_model_prices"])

    # intermediate --------------------------------------------------------
    @projection
    def priced_requests(self) -> DataFrame:
        """Staging requests + price + recomputed cost: the request grain of every mart.

        Arithmetic on a row and a lookup in the price sheet: its readers do it again, a copy of every request is not written."""
        return I.int_model_costs(self.stg_llm_requests, self.stg_daily_model_prices)

    @projection
    def model_day_requests(self) -> DataFrame:
        """The request columns of M18 and M21: no conversation column, hence no conversation join."""
        return M.requests_with_tier(self.priced_requests, self.model_catalog)

    @projection
    def int_model_costs(self) -> DataFrame:
        return I.model_costs_view(self.priced_requests)

    @dataset
    def int_conversation_request_rollup(self) -> DataFrame:
        return I.int_conversation_request_rollup(self.priced_requests)

    @dataset
    def int_conversation_quality(self) -> DataFrame:
        return I.int_conversation_quality(self.stg_conversations, self.stg_intent_predictions, self.stg_escalations)

    @dataset
    def conversation_facts(self) -> DataFrame:
        return M.conversation_facts(
            self.stg_conversations, self.int_conversation_request_rollup, self.int_conversation_quality)

    @dataset
    def int_daily_product_metrics(self) -> DataFrame:
        return I.int_daily_product_metrics(self.conversation_facts, self.priced_requests, self.stg_conversations)

    @dataset
    def int_intent_confusion(self) -> DataFrame:
        return I.int_intent_confusion(self.stg_intent_predictions)

    # marts ---------------------------------------------------------------
    @dataset
    def dim_users(self) -> DataFrame:
        return M.dim_users(self.stg_users, self.conversation_facts)

    @dataset
    def dim_models(self) -> DataFrame:
        return M.dim_models(self.model_catalog, self.stg_daily_model_prices, self.priced_requests)

    @dataset
    def dim_intents(self) -> DataFrame:
        return M.dim_intents(self.intent_catalog, self.stg_conversations)

    @dataset
    def fct_conversations(self) -> DataFrame:
        return M.fct_conversations(self.conversation_facts, self.stg_users)

    @dataset
    def fct_llm_requests(self) -> DataFrame:
        return M.fct_llm_requests(self.stg_llm_requests, self.stg_conversations, self.model_catalog, self.stg_daily_model_prices)

    @dataset
    def fct_daily_product_metrics(self) -> DataFrame:
        return M.fct_daily_product_metrics(self.int_daily_product_metrics)

    @dataset
    def fct_daily_model_costs(self) -> DataFrame:
        return M.fct_daily_model_costs(self.model_day_requests)

    @dataset
    def mart_intent_quality(self) -> DataFrame:
        return M.mart_intent_quality(self.fct_conversations, self.dim_intents)

    @dataset
    def mart_model_reliability_daily(self) -> DataFrame:
        return M.mart_model_reliability_daily(self.model_day_requests)

    @dataset
    def fct_weekly_cohort_retention(self) -> DataFrame:
        from ledgerlark.operators.cohorts import weekly_cohort_retention
        return weekly_cohort_retention(self.stg_users, self.stg_conversations)

    @dataset
    def mart_daily_anomalies(self) -> DataFrame:
        from ledgerlark.operators.anomalies import daily_anomalies
        return daily_anomalies(self.fct_daily_product_metrics, self.config.anomaly)

    def register_views(self, names: list[str] | None = None, prefix: str = "") -> list[str]:
        """S06 - expose datasets as temporary views for SQL users (still lazy plans)."""
        names = names or [
            "stg_users", "stg_conversations", "stg_llm_requests", "stg_intent_predictions", "stg_escalations",
            "stg_daily_model_prices", "int_model_costs", "int_conversation_request_rollup",
            "int_conversation_quality", "int_daily_product_metrics", "int_intent_confusion",
            *MART_NAMES,
        ]
        for n in names:
            getattr(self, n).createOrReplaceTempView(prefix + n)
        return [prefix + n for n in names]

    # data quality ---------------------------------------------------------
    def dataset(self, name: str) -> DataFrame:
        """Any layer by name: ``raw_<feed>``, seeds, staging, intermediate or mart."""
        if name.startswith("raw_"):
            return self.feeds[name[4:]]
        return getattr(self, name)

    @cached_property
    def sql_checks(self) -> dict[str, DataFrame]:
        """Q10-Q19: violating rows of each cross-mart invariant."""
        from ledgerlark.operators.invariants import sql_check_frames
        return sql_check_frames(self)

    @cached_property
    def check_suite(self) -> DataFrame:
        """Q09 - all declared checks plus the SQL invariants, one row per check."""
        from ledgerlark.operators.checks import DECLARED, run_checks
        from ledgerlark.operators.invariants import sql_check_results

        names = {c.dataset for c in DECLARED} | {c.parent[0] for c in DECLARED if c.parent}
        declared = run_checks({n: self.dataset(n) for n in names}, DECLARED)
        return declared.unionByName(sql_check_results(self.sql_checks))


MART_NAMES = (
    "dim_users", "dim_models", "dim_intents", "fct_conversations", "fct_llm_requests",
    "fct_daily_product_metrics", "fct_daily_model_costs", "fct_weekly_cohort_retention",
    "mart_intent_quality", "mart_model_reliability_daily", "mart_daily_anomalies",
)


# The DAG ---------------------------------------------------------------------
#: The consumer that stands for the check suite.
CHECKS = "check_suite"


def _reads(fn) -> set[str]:
    """Attributes that a definition reads off its first parameter, the warehouse.

    Operators carry the names of datasets too (``S.stg_users``, ``I.int_model_costs``): those are not reads.
    """
    definition = ast.parse(textwrap.dedent(inspect.getsource(fn))).body[0]
    warehouse = definition.args.args[0].arg
    return {x.attr for x in ast.walk(definition)
            if isinstance(x, ast.Attribute) and isinstance(x.value, ast.Name) and x.value.id == warehouse}


def dependencies() -> dict[str, set[str]]:
    """Datasets -> the datasets their definitions read, plus the check suite's; read off the definitions themselves."""
    from ledgerlark.operators.checks import DECLARED
    from ledgerlark.operators.invariants import SQL_CHECK_INPUTS

    nodes = {n: m for n, m in vars(Warehouse).items() if isinstance(m, dataset)}
    deps = {n: _reads(m.func) & nodes.keys() for n, m in nodes.items()}
    checked = {c.dataset for c in DECLARED} | {c.parent[0] for c in DECLARED if c.parent}
    checked |= {m for _, marts, _ in SQL_CHECK_INPUTS.values() for m in marts}
    return deps | {CHECKS: checked & nodes.keys()}


def _consumers_first(deps: dict[str, set[str]]) -> list[str]:
    order: list[str] = []
    left = {n: set() for n in deps}
    for n, reads in deps.items():
        for d in reads:
            left[d].add(n)
    while left:
        free = sorted(n for n, users in left.items() if not users - set(order))
        if not free:
            raise ValueError(f"datasets read each other: {sorted(left)}")
        order += free
        for n in free:
            del left[n]
    return order


def written_datasets(deps: dict[str, set[str]] | None = None, marts: tuple[str, ...] = ()) -> dict[str, set[str]]:
    """What a run writes -> the written datasets it has to wait for.

    Written are the marts, ``sized`` nodes, and every other dataset that two or more written
    datasets (the check suite is one) read, directly or through views.
    """
    deps = dependencies() if deps is None else deps
    marts = marts or MART_NAMES
    nodes = vars(Warehouse)
    readers: dict[str, set[str]] = {}   # the written datasets that read it
    written = []
    for n in _consumers_first(deps):
        users = {r for c, reads in deps.items() if n in reads for r in ({c} if c in written or c == CHECKS else readers[c])}
        readers[n] = users
        node = nodes.get(n)
        if n != CHECKS and (n in marts or getattr(node, "sized", False) or (len(users) > 1 and not getattr(node, "projection", False))):
            written.append(n)

    def needs(n: str) -> set[str]:
        return {x for d in deps[n] for x in ({d} if d in written else needs(d))}

    return {n: needs(n) for n in reversed(written)}


def written_for(reads: tuple[str, ...]) -> set[str]:
    """What a run has to write before ``reads`` can be read off written tables: their lineage, as a whole run writes it."""
    deps, written = dependencies(), written_datasets()
    found: set[str] = set()
    left = [n for n in reads if n in deps]   # raw feeds and seeds are written by no run
    while left:
        n = left.pop()
        if n not in found:
            found.add(n)
            left += deps[n]
    return found & written.keys()


def passing_datasets() -> dict[str, set[str]]:
    """Written datasets that only written ones read, neither marts nor checked -> those readers.

    Once all of these are written, nobody needs the files of the dataset.
    """
    deps, waits, members = dependencies(), written_datasets(), vars(Warehouse)
    through = {n: {x for a in _reads(m.func) if isinstance(members.get(a), property) for x in _reads(members[a].fget)}
               for n, m in members.items() if isinstance(m, dataset)}   # read by way of a plain property

    def written(names: set[str]) -> set[str]:
        return {x for d in names for x in ({d} if d in waits else written(deps[d] | through[d] & deps.keys()))}

    reads = {n: written(deps[n] | through.get(n, set()) & deps.keys()) for n in (*waits, CHECKS)}
    return {n: {m for m in waits if n in reads[m]} for n in waits if n not in MART_NAMES and n not in reads[CHECKS]}


def layer_of(name: str) -> str:
    """S08 - the namespace of a written dataset."""
    return "marts" if name in MART_NAMES else "staging" if name.startswith("stg_") else "intermediate"
