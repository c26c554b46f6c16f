"""shoplens: recommendation analytics over behaviour events, as Spark jobs."""
