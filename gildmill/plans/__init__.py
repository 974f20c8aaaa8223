"""The composed jobs. Each builds one logical plan per output table."""
