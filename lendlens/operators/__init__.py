"""Table operators: filters, cohort analyses, distributed ntile, scoring, decisions."""
