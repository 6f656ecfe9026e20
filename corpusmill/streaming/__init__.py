"""Micro-batch forms of the job log and of change capture."""
