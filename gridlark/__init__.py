"""Spreadsheets as Spark DataFrames."""

from gridlark.api import analyze_sheet, analyze_sheets, read_sheet, read_sheets, register

__all__ = ["analyze_sheet", "analyze_sheets", "read_sheet", "read_sheets", "register"]
