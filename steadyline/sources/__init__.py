"""Payload parsers, the timetable CSV and table sinks."""
