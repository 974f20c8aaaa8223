"""DataFrame -> DataFrame operators over any table; columns are arguments."""
