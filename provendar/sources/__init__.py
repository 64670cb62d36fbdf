"""Readers for the raw inputs and the contract tables."""
