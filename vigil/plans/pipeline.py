"""The whole monitoring run as one lazy DataFrame plan.

feed -> match every project's search -> de-duplicate (batch, then log) ->
cap per project (if asked for) -> log keys -> score with each project's model -> keep
above threshold -> attach entities -> posting projection -> result batches.

The driver only plans; config tables (projects, models, clauses, weights)
are broadcast behind size checks; the feed is never collected.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil import schemas
from vigil.functions.dates import prefer_source_date
from vigil.functions.urls import normalize_url
from vigil.operators import classify as C
from vigil.operators import dedupe as D
from vigil.operators import output as O
from vigil.operators import search as S
from vigil.operators import windows as W
from vigil.operators.common import store, unbounded
from vigil.operators.log import story_key


@dataclass
class RunResult:
    """The outputs of a run.  Scores and batches are planned when first asked
    for: numbering batches writes the numbered rows, which a caller who wants
    the summary or the log rows only need not pay for."""
    found: DataFrame       # (project, story) pairs matched by the searches
    kept: DataFrame        # after de-duplication and the cap if any, with log keys
    cut: DataFrame | None  # what a cap left out (None without a cap)
    late: DataFrame | None     # matched but outside the query window (with a history)
    history: DataFrame | None  # the new high-water marks (with a history)
    texts: DataFrame
    projects: DataFrame
    models: DataFrame
    model_terms: DataFrame
    source: str
    entities: DataFrame | None = None
    vectors: DataFrame | None = None   # (story_id, embedding) for models over vectors
    scorers: dict | None = None        # the caller's own models, by model_id

    @cached_property
    def stored(self) -> DataFrame:
        """``kept`` (ids, keys and light columns, no text) as a table in the
        shared folder: the search and the de-duplication run once, however many
        branches of the scoring plan read their result."""
        return store(self.kept, "kept")

    @cached_property
    def scored(self) -> DataFrame:
        """kept + scores; the feed has one row per story, so texts are
        tokenised where they are read."""
        return C.score(self.stored, self.projects, self.models, self.model_terms, id_col="story_id", texts=self.texts,
                       vectors=self.vectors, scorers=self.scorers)

    @cached_property
    def above(self) -> DataFrame:
        """Scored stories at or above their project's threshold."""
        above = C.above_threshold(self.scored, self.projects)
        return above if self.entities is None else O.attach_entities(above, self.entities)

    @cached_property
    def batches(self) -> DataFrame:
        """(project_id, batch_no, n_stories, payload)"""
        prepped = O.prep_for_posting(self.above.withColumn("source", F.lit(self.source)), self.projects)
        return O.result_batches(prepped, self.projects)

    @cached_property
    def bad(self) -> DataFrame:
        """Kept stories without text (NULL scores, reported)."""
        return C.unscorable(self.stored, self.texts)


@dataclass
class Kept:
    """What de-duplication and a cap leave of the found stories."""
    found: DataFrame
    kept: DataFrame
    cut: DataFrame | None

    def result(self, late: DataFrame | None, history: DataFrame | None, texts: DataFrame, projects: DataFrame, models: DataFrame,
               model_terms: DataFrame, source: str, entities: DataFrame | None = None, vectors: DataFrame | None = None,
               scorers: dict | None = None) -> RunResult:
        return RunResult(self.found, self.kept, self.cut, late, history, texts, projects, models, model_terms, source, entities, vectors, scorers)


def after_search(found: DataFrame, log: DataFrame | None, cap: int | None, newest: list, order_by: str) -> Kept:
    """First-wins de-duplication in the batch, then against the log; the cap if
    the caller names one; the key under which each story is logged."""
    kept = D.dedupe(found, order_by=order_by)
    if log is not None:
        kept = D.dedupe_against_log(kept, log)
    cut = None
    if cap is not None:
        kept, cut = D.cap_per_project(kept, cap, newest), D.cut_by_cap(kept, cap, newest)
    return Kept(found, kept.withColumn("log_db_id", story_key("project_id", F.coalesce("normalized_url", "url"))), cut)


def run(stories: DataFrame, projects: DataFrame, project_terms: DataFrame, models: DataFrame,
        model_terms: DataFrame, as_of: dt.datetime, source: str = schemas.SOURCE_MEDIA_CLOUD,
        log: DataFrame | None = None, entities: DataFrame | None = None,
        cap: int | None = None, history: DataFrame | None = None, vectors: DataFrame | None = None,
        scorers: dict | None = None) -> RunResult:
    """``stories``: canonical rows with a unique ``story_id`` (feed order),
    ``url, title, story_text, language, indexed_date`` and, if known,
    ``publish_date`` and the platform's ``source_publish_date`` (text; it wins
    where it is a date); no project yet.  Every story goes through unless the
    caller names a ``cap`` per project; what it leaves out is ``cut``.  With a
    ``history`` of marks only stories inside their project's window count; the
    others are ``late``, and the new marks come back."""
    if "publish_date" not in stories.columns:
        stories = stories.withColumn("publish_date", F.lit(None).cast("timestamp"))
    if "source_publish_date" in stories.columns:
        # The platform's own date wins over the one found in the page
        stories = stories.withColumn("publish_date", prefer_source_date("source_publish_date", "publish_date"))
    matches = S.match_projects(stories, project_terms, projects, doc_id="story_id")
    # only light columns travel through de-duplication and the cap; texts
    # are tokenised where they are read, for scoring only
    light = stories.select(*[c for c in stories.columns if c != "story_text"])
    # Stories split by project = the (project, story) match pairs joined back
    found = matches.join(unbounded(light), "story_id").withColumn("normalized_url", normalize_url("url"))
    late = marks = None
    if history is not None:
        windows = W.query_windows(projects, history, source, as_of)
        late = W.late_rows(found, windows)
        found = W.in_window(found, windows)
        marks = W.advance_history(history, found, source, as_of)
    done = after_search(found, log, cap, [F.desc_nulls_last("indexed_date"), F.col("url")], order_by="story_id")
    return done.result(late, marks, stories.select("story_id", "story_text"), projects, models, model_terms, source, entities, vectors, scorers)
