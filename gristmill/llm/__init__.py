"""Operators for preparing large corpora and record sets; nothing outside this folder imports it."""
