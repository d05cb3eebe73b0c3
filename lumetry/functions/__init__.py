from .measures import ANY_COST, COST, METER_MEASURES, Measure
from .parsing import (
    device_costs,
    device_readings,
    elements,
    event_time,
    lamp_readings,
    meter_readings,
    nonempty,
    parse,
    parse_array,
    payload_text,
    timed,
    to_document,
    with_cost_default,
    with_parse_status,
)
from .variants import as_variants, variant_elements, variant_readings

__all__ = [
    "ANY_COST",
    "COST",
    "METER_MEASURES",
    "Measure",
    "as_variants",
    "device_costs",
    "device_readings",
    "elements",
    "event_time",
    "lamp_readings",
    "meter_readings",
    "nonempty",
    "parse",
    "parse_array",
    "payload_text",
    "timed",
    "to_document",
    "variant_elements",
    "variant_readings",
    "with_cost_default",
    "with_parse_status",
]
