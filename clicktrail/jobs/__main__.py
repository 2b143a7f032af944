from clicktrail.jobs.cli import main

main()
