"""Scans, landed feeds, lake layers and exports."""
