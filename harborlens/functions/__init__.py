"""Scalar Column expressions shared by the operators (see ``scalars``)."""

from harborlens.functions.scalars import (
    cidr_high, cidr_low, cidr_prefix, compact_stamp, cpu_millis, default_if_empty, duration_seconds, epoch_seconds,
    epoch_micros, micros_between, slice0, template, ts_literal,
    image_tag, ipv4_to_long, memory_bytes, merge_labels, missing_to_null, ratio,
    sorted_map_json, strip_hosted_zone, strip_trailing_dot, tag_value, tags_to_map,
)

__all__ = [
    "cidr_high", "cidr_low", "cidr_prefix", "compact_stamp", "cpu_millis", "default_if_empty", "epoch_seconds",
    "epoch_micros", "micros_between", "slice0", "template", "ts_literal",
    "duration_seconds", "image_tag", "ipv4_to_long", "memory_bytes", "merge_labels",
    "missing_to_null", "ratio", "sorted_map_json", "strip_hosted_zone",
    "strip_trailing_dot", "tag_value", "tags_to_map",
]
