"""Row policies, analysis and table functions."""
