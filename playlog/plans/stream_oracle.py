"""Streaming queries equal their batch counterparts when nothing is dropped late."""

from __future__ import annotations

SAME_AS = {"stream_skip_rate": "skip_rate", "stream_top": "top_by_country",
           "stream_royalties": "royalties", "stream_fraud": "fraud_alerts",
           "stream_royalties_batches": "royalties",
           "stream_late_exact": "late_filtered_skip_rate",
           "stream_dlq": "dlq_messages", "stream_catalog": "catalog_latest"}


def oracle(batch_sql: dict[str, str]) -> dict[str, str]:
    return {k: batch_sql[v] for k, v in SAME_AS.items()}
