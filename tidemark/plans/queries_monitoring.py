"""Queries over the scored events table: metrics, drift, quality."""

from __future__ import annotations

from tidemark.plans.catalog import register
from tidemark.plans.fixtures import current_batches, reference_slice, scored_events
from tidemark.plans.monitoring import EVENTS_SPEC, batch_metrics
from tidemark.plans.sql import monitoring as S


def monitor_inputs(spark, sf_dir):
    scored = scored_events(spark, sf_dir)
    return reference_slice(scored), current_batches(spark, sf_dir)


@register("batch_metrics", S.BATCH_METRICS)
def q_batch_metrics(spark, sf_dir):
    ref, cur = monitor_inputs(spark, sf_dir)
    return batch_metrics(ref, cur, EVENTS_SPEC)
