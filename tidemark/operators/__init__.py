"""Grouping, partition and watermark operators."""

from .groups import flat_map_groups, group_by_key, map_groups
from .local_groups import fold_groups, partition_local, pre_aggregate
from .partitions import committed, map_partitions, map_partitions_summed
from .watermark import (
    SINGLE_WATERMARK,
    batch_watermarks,
    combined,
    mark_late,
    policy_setting,
    time_slot,
    watermark_audit,
    with_watermark,
)

__all__ = [
    "SINGLE_WATERMARK",
    "batch_watermarks",
    "combined",
    "committed",
    "flat_map_groups",
    "fold_groups",
    "group_by_key",
    "map_groups",
    "map_partitions",
    "map_partitions_summed",
    "mark_late",
    "partition_local",
    "policy_setting",
    "pre_aggregate",
    "time_slot",
    "watermark_audit",
    "with_watermark",
]
