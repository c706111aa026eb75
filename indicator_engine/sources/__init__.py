from indicator_engine.sources.extract import EXTRACTS, STUDENT_SAMPLE, Extract, extract
from indicator_engine.sources.raw import RAW_ENTITIES, read_csv_text, read_raw, with_provenance
from indicator_engine.sources.territory import state_dimension

__all__ = [
    "EXTRACTS",
    "RAW_ENTITIES",
    "STUDENT_SAMPLE",
    "Extract",
    "extract",
    "read_csv_text",
    "read_raw",
    "state_dimension",
    "with_provenance",
]
