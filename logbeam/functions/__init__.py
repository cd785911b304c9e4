"""logbeam.functions."""
