"""logbeam.sources."""
