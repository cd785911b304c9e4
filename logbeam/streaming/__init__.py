"""logbeam.streaming."""
