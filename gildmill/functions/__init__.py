"""Column -> Column expressions; none reads session settings or needs ANSI off."""
