from rushline.plans.report import profile_document, profile_tables, write_profile
from rushline.plans.run import prepare, processed_sample, profile_only, run

__all__ = [
    "prepare", "processed_sample", "profile_document", "profile_only", "profile_tables", "run",
    "write_profile",
]
