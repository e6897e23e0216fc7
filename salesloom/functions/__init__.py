from salesloom.functions.columns import first_element, parse_date, period_start, q
from salesloom.functions.payload import extract_payload

__all__ = ["extract_payload", "first_element", "parse_date", "period_start", "q"]
